import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from clickscope.llm import simhash as S
from clickscope.llm.queries import op7_simhash_components
from tests.conftest import SF_SMALL
from tests.llm.helpers import empty_docs, odd_docs, prose


def slow_print(text):
    words = [w for w in __import__("re").split("[ \t-\r]+", (text or "")) if w]
    words = ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w) for w in words]
    if not words:
        return 0
    grams = [" ".join(words[i: i + 3]) for i in range(max(1, len(words) - 2))]
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def slow_components(prints, bits=2):
    """{fp: smallest fp reachable} by comparing all pairs."""
    fps = sorted(set(prints))
    root = {f: f for f in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i, a in enumerate(fps):
        for b in fps[i + 1:]:
            if ((a ^ b) & (2**64 - 1)).bit_count() <= bits:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {f: find(f) for f in fps}


def expected(rows):
    prints = {}
    comp = slow_components([slow_print(t) for _, t in rows])
    least = {}
    for d, t in rows:
        c = comp[slow_print(t)]
        if d is not None:
            least[c] = min(d, least.get(c, d))
    return sorted(((d, f"{slow_print(t):016x}", least.get(comp[slow_print(t)])) for d, t in rows), key=repr), prints


def test_query_equals_brute_force(spark):
    rows = [(r[0], r[1]) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted(map(tuple, op7_simhash_components(spark, SF_SMALL).select("doc_id", "fingerprint", "component_id").collect()), key=repr)
    assert got == expected(rows)[0]


def test_odd_rows(spark):
    docs, rows = odd_docs(spark, extra=("fp", "root"))
    prints = docs.select("doc_id", S.fingerprint(F.col("text")).alias("fp"))
    got = S.near_duplicates(prints).select("doc_id", S.hex16(F.col("fp")), "component_id").collect()
    assert sorted(map(tuple, got), key=repr) == expected([(r[0], r[1]) for r in rows])[0]


def test_empty_table(spark):
    assert S.near_duplicates(empty_docs(spark).select("doc_id", S.fingerprint(F.col("text")).alias("fp"))).collect() == []
    assert S.one_of_each(empty_docs(spark)).collect() == []


def test_long_text_is_read_whole():
    text = prose(random.Random(2), 150_000)
    assert S.simhash64(text.encode()) == slow_print(text)


@pytest.mark.parametrize("bits", [1, 2])
@pytest.mark.parametrize("list_pairs", [2, 32])
def test_links_connect_like_all_pairs(spark, bits, list_pairs):
    rng = np.random.default_rng(1)
    fps = {int(x) for x in rng.integers(-2**63, 2**63, 300)}
    for c in list(fps)[:3]:
        near = c
        for _ in range(80):  # hot clusters and chains
            near ^= S._signed(1 << int(rng.integers(0, 64)))
            fps.add(near)
            fps.add(c ^ S._signed(1 << int(rng.integers(0, 16))))
    df = spark.createDataFrame([(f,) for f in fps], "fp long")
    want = slow_components(fps, bits)
    got = {r["node"]: r["root"] for r in S.components(S.links(df, bits, list_pairs)).collect()}
    assert {f: got.get(f, f) for f in fps} == want


def test_chain_of_links_has_one_root(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 700), (600, 700)], "u long, v long")
    got = {r["node"]: r["root"] for r in S.components(edges).collect()}
    assert got == {**{i: 0 for i in range(201)}, 500: 500, 600: 500, 700: 500}


def test_one_of_each(spark):
    docs, rows = odd_docs(spark, extra=("fp", "component_id"))
    kept = S.one_of_each(docs)
    assert kept.columns == docs.columns
    got = kept.collect()
    want = expected([(r[0], r[1]) for r in rows])[0]
    classes = slow_components([slow_print(r[1]) for r in rows])
    assert len(got) == len(set(classes.values())) == len({classes[slow_print(r["text"])] for r in got})
    # 27 stands twice: with two texts it is in two components
    assert {r["doc_id"] for r in got if r["doc_id"] is not None} == {c for _, _, c in want if c is not None}
