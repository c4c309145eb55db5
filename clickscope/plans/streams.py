"""Stream checks: the streaming jobs run over all test events, end to end.

The events are cut at fixed dates into three parts.  Each check appends a part
to a folder, runs the job with ``availableNow`` until it has taken it in (one
micro-batch) and stops it; the next part finds the job restarted from its
checkpoint, so state, prior counts and keyed upserts are carried across
batches and restarts.  The results must equal the batch reports, so the DuckDB
twins are the batch ones (``clickscope.plans.oracle``).  All files go to fresh
folders under the session's checkpoint folder.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from clickscope.config import CHECK
from clickscope.session import scratch_path
from clickscope.sources import bindings as B
from clickscope.sources.ads_log import parse_ads_log, text_ads_stream
from clickscope.streaming import ads_jobs as J

# Where the parts end (a click's part is the number of these dates that are not after it).
PART_DATES = ("2024-01-11", "2024-01-21")

TH = CHECK.blacklist_threshold
Start = Callable[[str, str, str], list[StreamingQuery]]


def _part(ts: str = "ts") -> F.Column:
    day = F.col(ts).cast("date").cast("string")
    return sum((F.when(day >= d, 1).otherwise(0) for d in PART_DATES), F.lit(0))


def _fed(spark: SparkSession, rows: DataFrame, fmt: str, name: str, start: Start) -> str:
    """Run the job over the parts of ``rows`` (with column ``_part``); returns the root of its tables."""
    root = scratch_path(spark, f"stream-{name}")
    # State partitions are fixed when a query first starts; size them to the
    # cluster's cores for these checks and give the session its setting back.
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    spark.conf.set(key, str(spark.sparkContext.defaultParallelism))
    try:
        for i in range(len(PART_DATES) + 1):
            rows.where(F.col("_part") == i).drop("_part").write.mode("append").format(fmt).save(f"{root}/in")
            for q in start(f"{root}/in", f"{root}/out", f"{root}/checkpoint"):
                q.awaitTermination()
                if q.exception() is not None:
                    raise RuntimeError(str(q.exception()))
    finally:
        spark.conf.set(key, before)
    return f"{root}/out"


def _clicks_job(spark: SparkSession, sf_dir: str, name: str, start) -> str:
    """Run ``start(clicks, out, checkpoint)`` over the events as a stream of ad clicks."""
    t = B.test_tables(spark, sf_dir)

    def begin(source: str, out: str, checkpoint: str) -> list[StreamingQuery]:
        return [start(B.ads_clicks(t, B.events_stream(t, folder=source)), out, checkpoint)]
    return _fed(spark, t.events.withColumn("_part", _part()), "parquet", name, begin)


def _counts(spark: SparkSession, sf_dir: str, table: str, mode: str) -> DataFrame:
    out = _clicks_job(spark, sf_dir, "counts", lambda c, o, k: J.start_running_counts(
        c, o, k, mode=mode, day_watermark="60 days" if mode == "update" else None, trigger=J.AVAILABLE_NOW))
    return J.read_table(spark, out, table)


def q_stream_day_area_city_ads(spark, sf_dir):
    return _counts(spark, sf_dir, "day_area_city_ads", "update")


def q_stream_day_area_city_ads_expiring(spark, sf_dir):
    """State of days that began two days before the newest one is dropped between the parts; the totals stay in the table."""
    out = _clicks_job(spark, sf_dir, "counts-expiring", lambda c, o, k: J.start_running_counts(
        c, o, k, mode="update", day_watermark="2 days", trigger=J.AVAILABLE_NOW))
    return J.read_table(spark, out, "day_area_city_ads")


def q_stream_area_ads_top3(spark, sf_dir):
    return _counts(spark, sf_dir, "area_ads_top3", "complete")


def q_stream_area_ads_top3_update(spark, sf_dir):
    return _counts(spark, sf_dir, "area_ads_top3", "update")


def q_stream_area_ads_top3_json(spark, sf_dir):
    return _counts(spark, sf_dir, "area_ads_top3_json", "update")


def q_stream_blacklist(spark, sf_dir):
    """State form."""
    out = _clicks_job(spark, sf_dir, "bl-state", lambda c, o, k: J.start_blacklist(
        c, o, k, threshold=TH, mode="batch", trigger=J.AVAILABLE_NOW))
    return J.read_blacklist(spark, out)


def q_stream_ads_not_blacklisted(spark, sf_dir):
    """State form, row by row."""
    out = _clicks_job(spark, sf_dir, "bl-row", lambda c, o, k: J.start_blacklist(
        c, o, k, threshold=TH, mode="row", trigger=J.AVAILABLE_NOW))
    return J.read_passed_clicks(spark, out).select("event_id", "user_id", "ads_id", "day", "area", "city")


def _blacklist_tables(spark, sf_dir, mode):
    out = _clicks_job(spark, sf_dir, f"bl-tables-{mode}", lambda c, o, k: J.start_blacklist_tables(
        c, o, k, threshold=TH, mode=mode, trigger=J.AVAILABLE_NOW))
    return J.read_blacklist_tables(spark, out)


def q_stream_blacklist_tables(spark, sf_dir):
    return _blacklist_tables(spark, sf_dir, "batch")[0]


def q_stream_blacklist_passed(spark, sf_dir):
    """Clicks of users who were not listed when their micro-batch began."""
    return _blacklist_tables(spark, sf_dir, "batch")[1].select("event_id", "user_id", "ads_id", "day", "area", "city")


def q_stream_blacklist_passed_row(spark, sf_dir):
    return _blacklist_tables(spark, sf_dir, "row")[1].select("event_id", "user_id", "ads_id", "day", "area", "city")


def _last_hour_out(spark, sf_dir):
    return _clicks_job(spark, sf_dir, "last-hour", lambda c, o, k: J.start_last_hour(c, o, k, trigger=J.AVAILABLE_NOW))


def q_stream_last_hour(spark, sf_dir):
    return J.read_last_hour(spark, _last_hour_out(spark, sf_dir)).select("ads_id", "minute", "click_count")


def q_stream_last_hour_json(spark, sf_dir):
    return J.read_last_hour_json(spark, _last_hour_out(spark, sf_dir))


def _pipeline(spark: SparkSession, sf_dir: str) -> str:
    """R6 over CSV lines, good and bad: parse, blacklist (snapshot), counts, rejects."""
    lines = B.ads_lines(B.test_tables(spark, sf_dir))

    def begin(source: str, out: str, checkpoint: str) -> list[StreamingQuery]:
        clicks, rejects = parse_ads_log(text_ads_stream(spark, source))
        return J.start_ads_jobs(clicks, out, checkpoint, rejects=rejects, threshold=TH, trigger=J.AVAILABLE_NOW)
    return _fed(spark, lines.select("value", _part().alias("_part")), "text", "pipeline", begin)


def q_ads_pipeline(spark, sf_dir):
    return J.read_table(spark, _pipeline(spark, sf_dir), "day_area_city_ads")


def q_ads_pipeline_rejects(spark, sf_dir):
    return spark.read.parquet(f"{_pipeline(spark, sf_dir)}/rejects")


STREAM_QUERIES = {
    "stream_day_area_city_ads": q_stream_day_area_city_ads,
    "stream_day_area_city_ads_expiring": q_stream_day_area_city_ads_expiring,
    "stream_area_ads_top3": q_stream_area_ads_top3,
    "stream_area_ads_top3_update": q_stream_area_ads_top3_update,
    "stream_area_ads_top3_json": q_stream_area_ads_top3_json,
    "stream_blacklist": q_stream_blacklist,
    "stream_ads_not_blacklisted": q_stream_ads_not_blacklisted,
    "stream_blacklist_tables": q_stream_blacklist_tables,
    "stream_blacklist_passed": q_stream_blacklist_passed,
    "stream_blacklist_passed_row": q_stream_blacklist_passed_row,
    "stream_last_hour": q_stream_last_hour,
    "stream_last_hour_json": q_stream_last_hour_json,
    "ads_pipeline": q_ads_pipeline,
    "ads_pipeline_rejects": q_ads_pipeline_rejects,
}
