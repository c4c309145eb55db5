"""The corpus pipeline: language ID, near-dedup, decontamination, mixing, sharding.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor
kept; ``run`` writes each result as Parquet to the shared folder and rereads
it.  All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from clickscope.llm import decontam, langid, mixing, sharding, simhash
from clickscope.llm.common import saved, table
from clickscope.llm.queries import FINGERPRINT_BITS, SHARDS, language_model


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised (null, letterless and rejected texts go)."""
    return langid.keep_recognised(docs, language_model(spark, sf_dir))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component stays."""
    return simhash.one_of_each(docs, max_bits=FINGERPRINT_BITS)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item."""
    return decontam.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sources at their target weights, documents repeated by epoch."""
    return mixing.mixed_documents(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows with their shard and slot."""
    return sharding.kd_shards(docs, n_shards=SHARDS)


STAGES = [("language_id", identify_language), ("simhash_near_dedup", drop_near_duplicates),
          ("benchmark_decontamination", drop_contaminated), ("source_mixing", mix_sources), ("sharding", shard)]

# SQL can't express the trained classifier; tests/llm hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
