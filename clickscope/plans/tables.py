"""Source and sink checks: whole tables written, read back and reported on.

Files go to fresh folders under the session's checkpoint folder, the managed
table to the session's warehouse.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickscope.config import CHECK
from clickscope.operators import area as AR
from clickscope.operators import category as C
from clickscope.operators.actions import filter_actions
from clickscope.schemas import ACTION_COLUMNS
from clickscope.session import scratch_path
from clickscope.sinks.tables import append_table, overwrite_table, save_table
from clickscope.sources import bindings as B
from clickscope.sources.ads_log import parse_ads_log
from clickscope.sources.tables import load_tables


def _category_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = B.test_tables(spark, sf_dir)
    return C.category_action_counts(filter_actions(B.actions(t), B.users(t), CHECK.condition, ts_col="ts"))


def q_load_tables(spark, sf_dir):
    """The four tables written to a folder, loaded by name, and the area report over them."""
    model, root = B.action_model(B.test_tables(spark, sf_dir)), scratch_path(spark, "load-tables")
    for name, df in (("user_visit_action", model.actions.select(*ACTION_COLUMNS)), ("user_info", model.users),
                     ("city_info", model.cities), ("product_info", model.products)):
        overwrite_table(df, f"{root}/{name}")
    m = load_tables(spark, path=root)
    return AR.area_top_products(m.actions, m.cities, m.products, other_label=CHECK.other_label)


def q_overwrite_table(spark, sf_dir):
    """K1: a table with other rows is replaced."""
    path, counts = scratch_path(spark, "overwrite-table"), _category_counts(spark, sf_dir)
    overwrite_table(counts.withColumn("click_count", F.lit(-1).cast("bigint")), path)
    overwrite_table(counts, path)
    return spark.read.parquet(path)


def q_append_table(spark, sf_dir):
    """K2: two runs in one table, told apart by task id."""
    path, counts = scratch_path(spark, "append-table"), _category_counts(spark, sf_dir)
    for task in ("run-1", "run-2"):
        append_table(counts.select(F.lit(task).alias("task_id"), *counts.columns), path)
    return spark.read.parquet(path)


def q_save_table(spark, sf_dir):
    """K4: the action log as a managed table partitioned by date, saved twice."""
    acts = B.actions(B.test_tables(spark, sf_dir)).select("event_id", *ACTION_COLUMNS)
    name = f"clickscope_check_{uuid.uuid4().hex[:12]}"
    save_table(acts, name, partition_by=["date"])
    save_table(acts, name, partition_by=["date"])
    return spark.table(name).select("event_id", *ACTION_COLUMNS)


def q_parse_ads_log(spark, sf_dir):
    """Clicks of CSV lines made from all events."""
    clicks, _ = parse_ads_log(B.ads_lines(B.test_tables(spark, sf_dir)))
    return clicks.withColumn("ts", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSS"))


def q_parse_ads_log_rejects(spark, sf_dir):
    return parse_ads_log(B.ads_lines(B.test_tables(spark, sf_dir)))[1]


TABLE_QUERIES = {
    "load_tables": q_load_tables,
    "overwrite_table": q_overwrite_table,
    "append_table": q_append_table,
    "save_table": q_save_table,
    "parse_ads_log": q_parse_ads_log,
    "parse_ads_log_rejects": q_parse_ads_log_rejects,
}
