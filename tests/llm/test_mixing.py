import hashlib
import math

import pytest
from pyspark.sql import functions as F

from clickscope.llm import mixing as M
from clickscope.llm.queries import op9_source_mix
from tests.conftest import SF_SMALL
from tests.llm.helpers import empty_docs, odd_docs


def n_words(t):
    return len((t or "").encode().split())


def slow_targets(sizes):
    """{source: target} by sharing again until none is above its cap."""
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: (1, 2, 3)[i % 3] for i, s in enumerate(names)}
    total, target, open_ = sum(sizes.values()), {}, set(names)
    while open_:
        left, w = total - sum(target.values()), sum(weight[s] for s in open_)
        over = {s for s in open_ if left * weight[s] / w >= 3 * sizes[s]}
        if not over:
            return target | {s: left * weight[s] / w for s in open_}
        target |= {s: 3 * sizes[s] for s in over}
        open_ -= over
    return target


def slow(rows):
    sizes = {}
    for _, s, n in rows:
        sizes[s] = sizes.get(s, 0) + n
    target, out = slow_targets(sizes), []
    for source, size in sizes.items():
        own = sorted((r for r in rows if r[1] == source), key=lambda r: (hashlib.md5(f"mix:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[2]))
        budget, before = math.floor(target[source] + 1e-9), 0
        whole = budget // size if size else 0
        for d, _, n in own:
            out.append((d, n, size, round(target[source], 6), whole * n + max(0, min(n, budget - whole * size - before))))
            before += n
    return sorted(out, key=repr)


def found(df):
    return sorted(((r["doc_id"], r["size"], r["source_size"], round(r["target"], 6), r["taken"]) for r in df.collect()), key=repr)


def test_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()
    got = found(op9_source_mix(spark, SF_SMALL))
    assert got == slow([(r["doc_id"], r["source"], n_words(r["text"])) for r in docs])
    by = {}
    for d, n, size, target, taken in got:
        assert 0 <= taken <= 3 * n
        by.setdefault((size, target), []).append(taken)
    for (_, target), taken in by.items():
        assert abs(sum(taken) - target) <= 1


@pytest.mark.parametrize("sizes", [{"a": 1000, "b": 1, "c": 1, "d": 50}, {"a": 10}, {"a": 0, "b": 7}, {None: 100, "": 1, "z": 400},
                                   {f"s{i}": 3**i for i in range(9)}, {"a": 0}])
def test_targets(spark, sizes):
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = M.targets(df.select(M._source_key(F.col("source")).alias("__source"), "source_size"))
    named = {M_name(r["__source"]): r["target"] for r in got.collect()}
    assert named == pytest.approx(slow_targets(sizes))


def M_name(key):
    return None if key == "n" else key[1:]


def _plan(docs):
    sized = docs.select("doc_id", "source", F.size(M.words(F.col("text"))).cast("long").alias("size"))
    return M.mix_plan(sized).withColumn("taken", M.taken())


def test_odd_rows_and_reruns(spark):
    docs, rows = odd_docs(spark)
    want = slow([(r[0], r[3], n_words(r[1])) for r in rows])
    assert found(_plan(docs)) == want
    assert found(_plan(docs.repartition(7))) == want


def test_documents_of_the_mix(spark):
    docs, rows = odd_docs(spark, extra=("size", "epochs", "target"))
    mixed = M.mixed_documents(docs)
    assert mixed.columns == docs.columns and mixed.schema["n_chars"].dataType == docs.schema["n_chars"].dataType
    got = mixed.collect()
    assert all(r["size"] == r["epochs"] == r["target"] == "x" for r in got)
    taken = {}
    for r in got:
        taken[r["source"]] = taken.get(r["source"], 0) + n_words(r["text"])
    sizes = {}
    for r in rows:
        sizes[r[3]] = sizes.get(r[3], 0) + n_words(r[1])
    target = slow_targets(sizes)
    for s in sizes:
        assert taken.get(s, 0) == math.floor(target[s] + 1e-9)
    whole = {(r[0], r[1]) for r in rows}
    cut = [r for r in got if (r["doc_id"], r["text"]) not in whole]
    assert len(cut) <= len(sizes) and all(r["n_chars"] == len(r["text"]) for r in cut)
    assert sorted(map(repr, M.mixed_documents(docs.repartition(5)).collect())) == sorted(map(repr, got))


def test_empty_table(spark):
    assert M.mixed_documents(empty_docs(spark)).collect() == []
    assert _plan(empty_docs(spark)).collect() == []
