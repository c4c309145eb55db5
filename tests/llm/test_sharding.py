import random

import pytest
from pyspark.sql import functions as F

from clickscope.llm.queries import op1_kd_shards
from clickscope.llm.sharding import kd_shards
from tests.conftest import SF_SMALL
from tests.llm.helpers import crc, empty_docs, odd_docs, prose


def _shards(df):
    out = {}
    for r in df.collect():
        out.setdefault(r["shard"], []).append(r)
    return out


def _sound(shards, n):
    assert set(shards) <= set(range(n))
    for rows in shards.values():
        assert sorted(r["slot"] for r in rows) == list(range(len(rows)))


def test_query_covers_every_document_in_near_equal_bytes(spark):
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    df = op1_kd_shards(spark, SF_SMALL)
    assert df.columns == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    shards = _shards(df)
    _sound(shards, 16)
    rows = [r for s in shards.values() for r in s]
    assert sorted(r["doc_id"] for r in rows) == sorted(docs)
    for r in rows:
        text = docs[r["doc_id"]]["text"]
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len((text or "").encode()) + 1, crc(text), "bytes", None)
    size = [sum(r["size"] for r in s) for s in shards.values()]
    most = max(r["size"] for r in rows)
    assert max(size) - min(size) <= 4 * most


def test_shares_follow_the_weights(spark):
    rng = random.Random(3)
    rows = [(i, "x" * rng.choice([1, 5, 50, 400]), "en" if i % 3 else "de", "hot" if i % 2 else f"s{i % 7}", 10) for i in range(4000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for n in (1, 5, 16):
        shards = _shards(kd_shards(docs, n_shards=n))
        _sound(shards, n)
        size = [sum(r["size"] for r in s) for s in shards.values()]
        assert len(size) == n and max(size) - min(size) <= 0.02 * sum(size) / n + 2 * 401


def test_leaves_are_boxes_of_the_tree(spark):
    # one dimension only: shards are ranges of it
    docs = spark.range(1000).select(F.col("id").alias("doc_id"), F.lit("abc").alias("text"))
    found = kd_shards(docs, target_bytes=1000, dims=[F.col("doc_id")])
    shards = _shards(found)
    assert len(shards) == 4
    ranges = sorted((min(r["doc_id"] for r in s), max(r["doc_id"] for r in s)) for s in shards.values())
    assert all(a[1] < b[0] for a, b in zip(ranges, ranges[1:]))
    assert [min(r["doc_id"] for r in shards[k]) for k in sorted(shards)] == [a for a, _ in ranges]


def test_ties_are_divided(spark):
    docs = spark.createDataFrame([(i, "same text", "en", "one", 9) for i in range(640)], "doc_id long, text string, lang string, source string, n_chars long")
    by_id = kd_shards(docs, n_shards=16, dims=[F.lit(5).cast("long")])
    assert sorted(len(s) for s in _shards(by_id).values()) == [40] * 16


def test_odd_rows_and_extra_columns(spark):
    docs, rows = odd_docs(spark, extra=("shard", "node", "dim"))
    found = kd_shards(docs, n_shards=4)
    got = found.collect()
    assert len(got) == len(rows)
    assert sorted(r["node"] for r in got) == ["x"] * len(rows)
    _sound(_shards(found), 4)


def test_empty_table(spark):
    assert kd_shards(empty_docs(spark), n_shards=16).collect() == []
    assert kd_shards(empty_docs(spark), target_bytes=10).collect() == []


def test_needs_one_measure(spark):
    with pytest.raises(ValueError):
        kd_shards(empty_docs(spark))


def test_long_text(spark):
    docs = spark.createDataFrame([(1, prose(random.Random(1), 400_000), "en", "a", 1), (2, "b", "en", "a", 1)],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    assert len(_shards(kd_shards(docs, n_shards=2))) == 2
