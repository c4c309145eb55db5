"""The ad-click log.

A record is the CSV text ``timestamp_ms,area,city,userid,adid``.  The same
parser serves batch and streaming frames.  Lines the reference would fail on
(too few fields, a timestamp that is not a number or far off) go to a rejects
frame instead of stopping the job.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _fields(value: Column) -> Column:
    # Java's String.split drops trailing empty pieces; strip them first so
    # "1,a,b,c," is short of a field here too.
    return F.split(F.regexp_replace(value, ",+$", ""), ",")


# Click times outside these bounds (epoch milliseconds) are taken for junk:
# 2000-01-01 up to 2100-01-01, UTC.
EARLIEST_MS, LATEST_MS = 946_684_800_000, 4_102_444_800_000


def parse_ads_log(lines: DataFrame, value_col: str = "value", *, earliest_ms: int = EARLIEST_MS,
                  latest_ms: int = LATEST_MS) -> tuple[DataFrame, DataFrame]:
    """Split CSV lines into (clicks, rejects).

    clicks: ts timestamp, area, city, user_id, ads_id, day (yyyy-MM-dd of ts in
    the session time zone).  rejects: the original line and a reason: too few
    fields, a timestamp that is no number, or one outside [earliest, latest).
    """
    parts = _fields(F.col(value_col))
    staged = (lines.select(F.col(value_col).alias("_line"), parts.alias("_parts"))
              .withColumn("_ts_ms", F.expr("try_cast(get(_parts, 0) AS BIGINT)"))
              .withColumn("_reason", F.when(F.col("_line").isNull() | (F.size("_parts") < 5), "too few fields")
                          .when(F.col("_ts_ms").isNull(), "bad timestamp")
                          .when((F.col("_ts_ms") < earliest_ms) | (F.col("_ts_ms") >= latest_ms), "timestamp out of range")))
    sound = F.when(F.col("_reason").isNull(), F.col("_ts_ms"))
    clicks = (staged.where("_reason IS NULL")
              .select(F.timestamp_millis(sound).alias("ts"),
                      F.col("_parts")[1].alias("area"),
                      F.col("_parts")[2].alias("city"),
                      F.col("_parts")[3].alias("user_id"),
                      F.col("_parts")[4].alias("ads_id"))
              .withColumn("day", F.date_format("ts", "yyyy-MM-dd")))
    rejects = staged.where("_reason IS NOT NULL").select(F.col("_line").alias("value"), F.col("_reason").alias("reason"))
    return clicks, rejects


def kafka_options(bootstrap_servers: str, topic: str, group_id: str | None = None,
                  starting_offsets: str = "latest", max_offsets_per_trigger: int | None = None,
                  fail_on_data_loss: bool = True, options: dict[str, str] | None = None) -> dict[str, str]:
    """Consumer settings of the reference's direct stream, as source options.

    Offsets are tracked in the query checkpoint instead of being auto-committed
    to the broker, which makes a restarted query resume exactly where the last
    committed micro-batch ended; offsets that have expired meanwhile stop the
    query unless ``fail_on_data_loss`` is off.  ``max_offsets_per_trigger``
    bounds a micro-batch: a backlog is worked off over several batches, nothing
    is dropped, but the snapshot blacklist (``mode="batch"``) filters by batch,
    so where batches are cut decides which clicks pass.  ``options`` adds
    further source or consumer (``kafka.*``) settings, security among them.
    """
    opts = {
        "kafka.bootstrap.servers": bootstrap_servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
        "failOnDataLoss": str(fail_on_data_loss).lower(),
    }
    if max_offsets_per_trigger:
        opts["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    if group_id:
        opts["kafka.group.id"] = group_id
    return {**opts, **(options or {})}


def kafka_ads_stream(spark: SparkSession, bootstrap_servers: str, topic: str = "ads_log", **settings) -> DataFrame:
    """S3: streaming frame of record values (needs the Kafka connector jar; settings as in ``kafka_options``)."""
    reader = spark.readStream.format("kafka").options(**kafka_options(bootstrap_servers, topic, **settings))
    return reader.load().select(F.col("value").cast("string").alias("value"))


def text_ads_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """File-based stand-in for S3: one CSV record per line of text files."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(path)
