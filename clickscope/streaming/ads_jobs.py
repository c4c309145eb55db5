"""The ad-click stream jobs and their serving tables.

Every job is one Structured Streaming query with its own checkpoint and a
``foreachBatch`` sink that writes keyed serving tables (K5) or a folder named
by batch id, so a retried micro-batch rewrites the same output.  The last thing
a batch writes is its record in the query's commit log: readers of all tables
of a query see the same batches, and none in part.  The per-batch
work calls the batch operators of ``clickscope.operators.ads``.

Serving tables under ``out_root``:

* ``day_area_city_ads`` (R3)  keys day, area, city, ads_id -> click_count
* ``area_ads_top3`` (R4)      day, area, ads_id, click_count, rank
* ``area_ads_top3_json`` (R4) day, area -> ads_json
* ``last_hour`` (R5)          ads_id, minute_start -> click_count
* ``blacklist_counters`` / ``blacklist_listed`` / ``blacklist_passed``
  (R1/R2) counters per (user, day, ad), listed users, passed clicks
* ``blacklist_events`` (R1/R2, state form) file-sink table, kind=pass|listed
* ``rejects`` (S2)            lines that are no clicks, with the reason
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from clickscope.config import BLACKLIST_THRESHOLD, LAST_HOUR_MINUTES, TOP_ADS
from clickscope.operators import ads as A
from clickscope.streaming.blacklist import blacklist_stream
from clickscope.streaming.keyed import CommitLog, KeyedTable, distinct_values


@dataclass(frozen=True)
class Trigger:
    """``processing_time`` for a live query (the reference uses 1 s
    micro-batches); ``available_now`` to process what is there and stop."""

    processing_time: str | None = "1 second"
    available_now: bool = False

    def apply(self, writer):
        if self.available_now:
            return writer.trigger(availableNow=True)
        return writer.trigger(processingTime=self.processing_time)


AVAILABLE_NOW = Trigger(processing_time=None, available_now=True)


def _once(spark: SparkSession, commits: CommitLog, apply: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` step that records each batch when ``apply`` is done with it, and skips recorded ones."""
    last = commits.last(spark)

    def write(batch: DataFrame, batch_id: int) -> None:
        nonlocal last
        if batch_id <= last:  # complete, but stopped before the query's own checkpoint knew
            return
        apply(batch, batch_id)
        commits.record(spark, batch_id)
        last = batch_id
    return write


def _commits(checkpoint: str) -> CommitLog:
    return CommitLog(f"{checkpoint.rstrip('/')}/serving-commits")


def _path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}"


def _all_at_once(spark: SparkSession, *steps: Callable[[], object]) -> None:
    """Run the independent writes of a micro-batch side by side; the first error is raised when all have ended."""
    with ThreadPoolExecutor(len(steps)) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(s)) for s in steps]
    for r in running:
        r.result()


# ---------------------------------------------------------------- R3 + R4

def start_running_counts(clicks: DataFrame, out_root: str, checkpoint: str, *,
                         mode: str = "update", day_watermark: str | None = None,
                         top: int = TOP_ADS, trigger: Trigger = Trigger(), reset: bool = False,
                         name: str | None = None) -> StreamingQuery:
    """R3 running totals per (day, area, city, ad), R4 top ads per (day, area).

    ``update``: only changed totals arrive, those of cities and those of all
    cities together from one aggregation.  The former are upserted into R3, the
    latter are merged with the ``top`` ads so far into R4, so no totals are
    read back; the tables are partitioned by day.  With ``day_watermark`` (e.g. "2 days") state is
    dropped for days that began so long before the newest day, in the session
    time zone; clicks of such days are dropped too.  ``complete``: every batch
    emits and writes all totals, as the reference does; state never expires,
    and each batch adds a whole copy of the tables until they are compacted.
    """
    if day_watermark and mode != "update":
        raise ValueError("a watermark needs update mode")
    if mode == "update":
        # each click counts for its city and, in a row of its own, for all cities
        parts = F.inline(F.array(F.struct(F.lit(False).alias("_all"), F.col("city").alias("city")),
                                 F.struct(F.lit(True).alias("_all"), F.lit(None).cast("string").alias("city"))))
        keys = ["day", "area", "_all", "city", "ads_id"]
        if day_watermark:
            # the watermark is on the start of the session-zone day, so that there
            # is one state row for each (day, area, city, ad)
            items = clicks.select("day", "area", "ads_id", F.date_trunc("day", "ts").alias("_day_start"), parts)
            grouped = items.withWatermark("_day_start", day_watermark).groupBy("_day_start", *keys)
        else:
            grouped = clicks.select("day", "area", "ads_id", parts).groupBy(*keys)
        counts = grouped.agg(F.count(F.lit(1)).alias("click_count")).select(*keys, "click_count")
    else:
        counts = A.day_area_city_ads(clicks).withColumn("_all", F.lit(False))
    r3, r4, r4j = (_table(out_root, n) for n in ("day_area_city_ads", "area_ads_top3", "area_ads_top3_json"))
    commits = _commits(checkpoint)
    for t in (r3, r4, r4j):
        t.claim(clicks.sparkSession, checkpoint, reset, commits)

    for t in (r3, r4, r4j):
        t.pinned(clicks.sparkSession)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            days = distinct_values(batch, "day")
            if not days:
                return
            totals = batch.where(~F.col("_all")).drop("_all")
            if mode == "complete":
                top3 = A.area_ads_top3(totals, top)
            else:
                before = r4.read(batch.sparkSession, below=batch_id, only=days)
                top3 = A.area_ads_top3_update(before, batch.where("_all"), top)
            _write_counts(batch.sparkSession, batch_id, totals, top3, r3, r4, r4j)
        finally:
            batch.unpersist()

    w = (counts.writeStream.outputMode(mode).foreachBatch(_once(clicks.sparkSession, commits, write))
         .option("checkpointLocation", checkpoint))
    if name:
        w = w.queryName(name)
    return trigger.apply(w).start()


def _write_counts(spark: SparkSession, batch_id: int, totals: DataFrame, top3: DataFrame,
                  r3: KeyedTable, r4: KeyedTable, r4j: KeyedTable, *more: Callable[[], object]) -> None:
    top3 = top3.persist()
    try:
        _all_at_once(spark, lambda: r3.upsert(totals, batch_id), lambda: r4.upsert(top3, batch_id),
                     lambda: r4j.upsert(A.area_ads_top3_json(top3), batch_id), *more)
    finally:
        top3.unpersist()


# ---------------------------------------------------------------- R5

def start_last_hour(clicks: DataFrame, out_root: str, checkpoint: str, *,
                    minutes: int = LAST_HOUR_MINUTES, trigger: Trigger = Trigger(), reset: bool = False,
                    name: str | None = None) -> StreamingQuery:
    """Clicks per (ad, minute) with a ``minutes`` event-time watermark.

    Incremental minute counts in state (the reference recomputes the whole
    hour from raw events every 5 s).  Changed minutes are upserted, by day;
    the serving view shows the ``minutes`` whole minutes that end with the
    newest one.  State for minutes behind the watermark is evicted; a click
    that arrives behind it may be dropped by Spark (then counted in the
    progress metric ``numRowsDroppedByWatermark``) and lies outside the view
    either way.
    """
    counts = (clicks.withWatermark("ts", f"{int(minutes)} minutes")
              .groupBy(F.window("ts", "1 minute").alias("w"), "ads_id")
              .agg(F.count(F.lit(1)).alias("click_count"))
              .select("ads_id", F.col("w.start").alias("minute_start"),
                      F.date_format("w.start", "yyyy-MM-dd").alias("day"), "click_count"))
    table = _table(out_root, "last_hour")
    commits = _commits(checkpoint)
    table.claim(clicks.sparkSession, checkpoint, reset, commits)
    table.pinned(clicks.sparkSession)

    def write(batch: DataFrame, batch_id: int) -> None:
        if not batch.isEmpty():
            table.upsert(batch, batch_id)

    w = (counts.writeStream.outputMode("update").foreachBatch(_once(clicks.sparkSession, commits, write))
         .option("checkpointLocation", checkpoint))
    if name:
        w = w.queryName(name)
    return trigger.apply(w).start()


def read_last_hour(spark: SparkSession, out_root: str, minutes: int = LAST_HOUR_MINUTES) -> DataFrame | None:
    """Serving view of R5: the ``minutes`` whole minutes that end with the newest one."""
    days = -(-minutes // (24 * 60)) + 1  # the window can begin the day before
    t = _table(out_root, "last_hour").read(spark, last_days=days)
    if t is None:
        return None
    newest = t.select(F.max("minute_start")).scalar()
    return (t.where(F.col("minute_start") >= A.last_hour_start(newest, minutes))
            .select("ads_id", "minute_start",
                    F.date_format("minute_start", "HH:mm").alias("minute"), "click_count"))


def read_last_hour_json(spark: SparkSession, out_root: str, minutes: int = LAST_HOUR_MINUTES) -> DataFrame | None:
    """R5 serving form of the reference: one JSON per ad, ``[{"HH:mm":count},...]``."""
    t = read_last_hour(spark, out_root, minutes)
    return None if t is None else A.last_hour_json(t)


# ---------------------------------------------------------------- R1 + R2

def start_blacklist(clicks: DataFrame, out_root: str, checkpoint: str, *,
                    threshold: int = BLACKLIST_THRESHOLD, mode: str = "batch", watermark: str | None = None,
                    trigger: Trigger = Trigger(), name: str | None = None) -> StreamingQuery:
    """R1 + R2 in state form: passed clicks (kind=pass) and listing events (kind=listed).

    For moderate rates: see ``blacklist_stream`` for what one task holds.
    Written by the Parquet file sink: its commit log makes the output
    exactly-once, and readers (batch or stream) see committed files only.
    """
    events = blacklist_stream(clicks, threshold, mode, watermark)
    w = (events.writeStream.format("parquet").outputMode("append").partitionBy("kind")
         .option("path", _path(out_root, "blacklist_events"))
         .option("checkpointLocation", checkpoint))
    if name:
        w = w.queryName(name)
    return trigger.apply(w).start()


def start_blacklist_tables(clicks: DataFrame, out_root: str, checkpoint: str, *,
                           threshold: int = BLACKLIST_THRESHOLD, mode: str = "batch",
                           trigger: Trigger = Trigger(), reset: bool = False, counts: bool = False,
                           top: int = TOP_ADS, name: str | None = None) -> StreamingQuery:
    """R1 + R2 in the reference's per-batch form, on the JVM only.

    Each micro-batch: read the listed users as they stood before it, drop
    their clicks (snapshot filter, R2), add the batch's clicks to the
    (user, day, ad) counters (all clicks, as the reference counts them), and
    list the users whose counter reaches ``threshold`` (R1).  Counters, the
    list and the passed clicks are read "below the batch id", so a replayed
    batch starts from the same state; counters and passed clicks are
    partitioned by day, the list only grows by new users.  ``mode="row"``
    filters exactly per click instead (the batch operator with the stored
    counters as prior).  With ``counts`` the batch's passed clicks are added
    to the tables of R3, R4 and R5 as well, under the same batch id.
    """
    if mode not in ("batch", "row"):
        raise ValueError("mode is 'batch' or 'row'")
    own = ["blacklist_counters", "blacklist_listed", "blacklist_passed"]
    if counts:
        own += ["day_area_city_ads", "area_ads_top3", "area_ads_top3_json", "last_hour"]
    commits = _commits(checkpoint)
    tables = {n: _table(out_root, n) for n in own}
    for t in tables.values():
        t.claim(clicks.sparkSession, checkpoint, reset, commits)
        t.pinned(clicks.sparkSession)

    def write(batch: DataFrame, batch_id: int) -> None:
        apply_blacklist_batch(batch, batch_id, tables, threshold, mode, counts, top)

    w = (clicks.writeStream.outputMode("append").foreachBatch(_once(clicks.sparkSession, commits, write))
         .option("checkpointLocation", checkpoint))
    if name:
        w = w.queryName(name)
    return trigger.apply(w).start()


def apply_blacklist_batch(batch: DataFrame, batch_id: int, tables: str | dict[str, KeyedTable],
                          threshold: int = BLACKLIST_THRESHOLD, mode: str = "batch", counts: bool = False,
                          top: int = TOP_ADS) -> None:
    """One micro-batch of ``start_blacklist_tables`` (idempotent per batch id; the batch is read once).

    ``tables``: the serving tables by name, or the folder they are in.
    """
    keys = ["user_id", "day", "ads_id"]
    if isinstance(tables, str):
        tables = {n: _table(tables, n) for n in TABLE_KEYS}
    counters, listed, passed_table = (tables[n] for n in ("blacklist_counters", "blacklist_listed", "blacklist_passed"))
    spark = batch.sparkSession
    kept = [batch.persist()]
    try:
        days = distinct_values(batch, "day")
        if not days:
            return
        base = counters.read(spark, below=batch_id, only=days)
        snapshot = listed.read(spark, below=batch_id)
        passed = batch if snapshot is None else A.drop_blacklisted(batch, snapshot)
        if mode == "row":
            passed = A.ads_not_blacklisted(passed, threshold, prior=base)
        if passed is not batch:
            passed = passed.persist()
            kept.append(passed)
        totals = _added(batch.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")), base, keys, "n").persist()
        kept.append(totals)
        new = totals.where(F.col("n") >= threshold).select("user_id").distinct()
        if snapshot is not None:
            new = new.join(snapshot, "user_id", "left_anti")
        steps = [lambda: passed_table.upsert(passed, batch_id), lambda: counters.upsert(totals, batch_id),
                 lambda: listed.upsert(new, batch_id)]
        if counts:
            steps.append(lambda: count_batch(passed, batch_id, tables, days, top))
        _all_at_once(spark, *steps)
    finally:
        for df in reversed(kept):
            df.unpersist()


def _added(inc: DataFrame, base: DataFrame | None, keys: list[str], value: str) -> DataFrame:
    """Increments plus the stored totals of their keys."""
    if base is None:
        return inc
    return (inc.join(base.select(*keys, F.col(value).alias("_stored")), keys, "left")
            .withColumn(value, F.col(value) + F.coalesce(F.col("_stored"), F.lit(0))).drop("_stored"))


def count_batch(clicks: DataFrame, batch_id: int, tables: dict[str, KeyedTable], days: list[str], top: int = TOP_ADS) -> None:
    """Add one batch of clicks, all of ``days``, to the tables of R3, R4 and R5 (idempotent per batch id).

    Of the stored totals one look keeps those of the ads that were clicked, in
    all cities: R3's new rows and the ads' new totals come from them, and R4
    from these totals and the top ads so far.
    """
    spark = clicks.sparkSession
    r3, r4, r4j, r5 = (tables[n] for n in ("day_area_city_ads", "area_ads_top3", "area_ads_top3_json", "last_hour"))
    kept = [A.day_area_city_ads(clicks).persist()]
    try:
        inc, stored = kept[0], r3.read(spark, below=batch_id, only=days)
        if stored is None:
            totals = changed = inc
        else:
            ads = ["day", "area", "ads_id"]
            stored = stored.join(inc.select(*ads).distinct(), ads, "left_semi").persist()
            kept.append(stored)
            totals, changed = _added(inc, stored, r3.keys, "click_count"), inc.unionByName(stored)
        top3 = A.area_ads_top3_update(r4.read(spark, below=batch_id, only=days), A.ads_totals(changed), top)
        minutes = (clicks.groupBy("ads_id", F.date_trunc("minute", "ts").alias("minute_start"), "day")
                   .agg(F.count(F.lit(1)).alias("click_count")))
        minutes = _added(minutes, r5.read(spark, below=batch_id, only=days), r5.keys, "click_count")
        _write_counts(spark, batch_id, totals, top3, r3, r4, r4j, lambda: r5.upsert(minutes, batch_id))
    finally:
        for df in reversed(kept):
            df.unpersist()


def read_blacklist_tables(spark: SparkSession, out_root: str) -> tuple[DataFrame | None, DataFrame | None]:
    """(listed users, passed clicks) written by ``start_blacklist_tables``."""
    return _table(out_root, "blacklist_listed").read(spark), _table(out_root, "blacklist_passed").log(spark)


def read_blacklist(spark: SparkSession, out_root: str) -> DataFrame:
    """R1 serving form: the listed users (user_id)."""
    ev = spark.read.parquet(_path(out_root, "blacklist_events"))
    return ev.where(F.col("kind") == "listed").select("user_id").distinct()


def read_passed_clicks(spark: SparkSession, out_root: str) -> DataFrame:
    """R2 output: clicks that passed the blacklist."""
    ev = spark.read.parquet(_path(out_root, "blacklist_events"))
    return ev.where(F.col("kind") == "pass").drop("kind")


TABLE_KEYS = {"day_area_city_ads": ["day", "area", "city", "ads_id"], "area_ads_top3": ["day", "area"],
              "area_ads_top3_json": ["day", "area"], "last_hour": ["ads_id", "minute_start"],
              "blacklist_counters": ["user_id", "day", "ads_id"], "blacklist_listed": ["user_id"], "blacklist_passed": []}


def _table(out_root: str, name: str) -> KeyedTable:
    return KeyedTable(_path(out_root, name), TABLE_KEYS[name], None if name == "blacklist_listed" else "day",
                      unique=bool(TABLE_KEYS[name]) and name != "area_ads_top3")


def read_table(spark: SparkSession, out_root: str, name: str) -> DataFrame | None:
    """Current state of a serving table."""
    return _table(out_root, name).read(spark)


def compact_tables(spark: SparkSession, out_root: str) -> list[str]:
    """Maintenance while no query runs: each keyed table's newest rows in one folder; returns the folders of before."""
    old = [_table(out_root, n).compact(spark) for n, keys in TABLE_KEYS.items() if keys]
    return [p for p in old if p]


def start_rejects(rejects: DataFrame, out_root: str, checkpoint: str, *, trigger: Trigger = Trigger(),
                  name: str | None = None) -> StreamingQuery:
    """Lines that are no clicks, with the reason, appended to the ``rejects`` table (file sink)."""
    w = (rejects.writeStream.format("parquet").outputMode("append")
         .option("path", _path(out_root, "rejects")).option("checkpointLocation", checkpoint))
    if name:
        w = w.queryName(name)
    return trigger.apply(w).start()


# ---------------------------------------------------------------- R6

def start_ads_jobs(clicks: DataFrame, out_root: str, checkpoint_root: str, *,
                   rejects: DataFrame | None = None, threshold: int = BLACKLIST_THRESHOLD,
                   blacklist_mode: str = "batch", filter_blacklisted: bool = True, counts_mode: str = "update",
                   day_watermark: str | None = None, trigger: Trigger = Trigger(), reset: bool = False) -> list[StreamingQuery]:
    """Blacklist (R1/R2), running counts + top 3 (R3/R4), last hour (R5), rejects.

    With ``filter_blacklisted`` (the reference's commented-out intent) the
    clicks that pass the blacklist are counted in the same query and under the
    same batch id, so a retried batch counts once in every table.  Without it
    the counting jobs read all clicks, each a query with its own checkpoint
    and state; give ``day_watermark`` then for a job that runs for long, or
    the totals of every day stay in state (``counts_mode`` and the watermark
    apply to that form only).
    """
    ck = checkpoint_root.rstrip("/")
    queries = [start_blacklist_tables(clicks, out_root, f"{ck}/blacklist", threshold=threshold, mode=blacklist_mode,
                                      counts=filter_blacklisted, trigger=trigger, reset=reset)]
    if rejects is not None:
        queries.append(start_rejects(rejects, out_root, f"{ck}/rejects", trigger=trigger))
    if not filter_blacklisted:
        queries.append(start_running_counts(clicks, out_root, f"{ck}/running_counts", mode=counts_mode,
                                            day_watermark=day_watermark, trigger=trigger, reset=reset))
        queries.append(start_last_hour(clicks, out_root, f"{ck}/last_hour", trigger=trigger, reset=reset))
    return queries
