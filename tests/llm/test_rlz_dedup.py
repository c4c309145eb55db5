import hashlib
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from clickscope.llm.queries import op4_rlz_dedup
from clickscope.llm.rlz_dedup import dedup_substrings
from tests.conftest import SF_SMALL
from tests.llm.helpers import empty_docs, odd_docs, prose


def slow(rows, window):
    first, split = {}, []
    for d, t in rows:
        w = (t or "").encode().split()
        split.append((d, w))
        if d is not None:
            for i in range(len(w) - window + 1):
                key = tuple(w[i: i + window])
                first[key] = min(d, first.get(key, d))
    out = []
    for d, w in split:
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if d is not None and first[tuple(w[i: i + window])] < d:
                gone[i: i + window] = [True] * window
        out.append((d, len(w), sum(gone), b" ".join(x for x, g in zip(w, gone, strict=True) if not g).decode()))
    return sorted(out, key=repr)


def found(df):
    return sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["kept"]) for r in df.collect()), key=repr)


def test_query_equals_brute_force(spark):
    rows = [(r[0], r[1]) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted(map(tuple, op4_rlz_dedup(spark, SF_SMALL).collect()), key=repr)
    want = sorted(((d, n, g, hashlib.sha256(k.encode()).hexdigest()) for d, n, g, k in slow(rows, 50)), key=repr)
    assert got == want


@pytest.mark.parametrize("window", [3, 20, 50])
def test_odd_rows(spark, window):
    docs, rows = odd_docs(spark, extra=("spans", "content"))
    df = dedup_substrings(docs, window)
    assert found(df) == slow([(r[0], r[1]) for r in rows], window)
    for r in df.collect():
        assert sum(s["n_words"] for s in r["spans"]) == r["n_removed"]


def _edited(rng, words, vocabulary):
    words = list(words)
    for _ in range(rng.randint(0, 4)):
        at = rng.randrange(len(words) + 1)
        words[at: at + rng.choice([0, 0, 1, 3, 30])] = [rng.choice(vocabulary) for _ in range(rng.choice([0, 1, 2]))]
    return words


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.integers(0, 10**6))
def test_edited_copies_and_periodic_texts(spark, seed):
    rng = random.Random(seed)
    vocabulary = ["a", "b"] if seed % 2 else prose(rng, 50).split()
    base = [[rng.choice(vocabulary) for _ in range(rng.randint(5, 150))] for _ in range(3)]
    passage = [rng.choice(vocabulary) for _ in range(60)]
    rows = []
    for d in range(25):
        w = _edited(rng, rng.choice(base), vocabulary)
        if rng.random() < 0.4:
            at = rng.randrange(len(w) + 1)
            w[at:at] = passage
        rows.append((rng.randrange(30), rng.choice([" ", "\n", " \t "]).join(w) + rng.choice(["", " "])))
    rows.append((3, " ".join(["same"] * 200)))
    rows.append((9, " ".join(["same"] * 90)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(dedup_substrings(docs, 20)) == slow(rows, 20)


def test_very_long_text(spark):
    rng = random.Random(5)
    long = prose(rng, 400_000)
    w = long.split()
    rows = [(1, long), (2, " ".join(w[1000:1100])), (3, " ".join(w[399_900:] + w[:60]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(dedup_substrings(docs, 50)) == slow(rows, 50)


def test_empty_table(spark):
    assert dedup_substrings(empty_docs(spark)).collect() == []


def test_words_that_agree_in_a_rolling_hash_are_different_words(spark):
    # the Thue-Morse word and its complement have equal polynomial hashes modulo 2^64 for every base
    morse = "".join("ab"[bin(i).count("1") % 2] for i in range(1_024))
    other = morse.translate(str.maketrans("ab", "ba"))
    same = " ".join(f"w{i}" for i in range(49))
    rows = [(0, f"{same} {morse}"), (1, f"{same} {other}"), (2, f"{same}\n {morse}"), (3, " "), (4, f"x {same} {other} y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id: r.n_removed for r in dedup_substrings(docs, 50).collect()} == {0: 0, 1: 0, 2: 50, 3: 0, 4: 50}
