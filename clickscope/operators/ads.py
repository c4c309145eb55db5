"""R1-R5 as batch operators over parsed ad clicks.

Input columns: ts (event time), area, city, user_id, ads_id, day, and
optionally ``event_id`` (tie-break for equal times).  The streaming jobs in
``clickscope.streaming`` call these same functions on each micro-batch or on
the streaming frame, so stream and batch results agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickscope.config import BLACKLIST_THRESHOLD, LAST_HOUR_MINUTES, TOP_ADS
from clickscope.functions.text import json_pairs


def _time_order(df: DataFrame) -> list[Column]:
    cols = [F.col("ts").asc()]
    if "event_id" in df.columns:
        cols.append(F.col("event_id").asc())
    return cols


# ---------------------------------------------------------------- R3 / R4

def day_area_city_ads(clicks: DataFrame) -> DataFrame:
    """Clicks per (day, area, city, ads_id) -> click_count."""
    return (clicks.groupBy("day", "area", "city", "ads_id")
            .agg(F.count(F.lit(1)).alias("click_count")))


def area_ads_top3(day_counts: DataFrame, k: int = TOP_ADS) -> DataFrame:
    """Roll R3 up over cities, keep the k largest ads per (day, area).

    Exactly k rows per group (row_number; ties by ads_id text).
    Columns: day, area, ads_id, click_count, rank.
    """
    return _largest(ads_totals(day_counts), k)


def ads_totals(day_counts: DataFrame) -> DataFrame:
    """R3 rolled up over cities: day, area, ads_id, click_count."""
    return (day_counts.groupBy("day", "area", "ads_id")
            .agg(F.sum("click_count").cast("bigint").alias("click_count")))


def _largest(totals: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("day", "area").orderBy(F.desc("click_count"), F.asc("ads_id"))
    return (totals.withColumn("rank", F.row_number().over(w).cast("bigint"))
            .where(F.col("rank") <= k))


def area_ads_top3_update(before: DataFrame | None, changed: DataFrame, k: int = TOP_ADS) -> DataFrame:
    """R4 of the (day, area) groups in ``changed``, from their k largest ads ``before`` and the changed totals.

    ``changed`` has the new totals (day, area, ads_id, click_count) of the ads
    that were clicked.  Totals only grow: an ad that was not clicked and was
    not among the k largest can't have come among them, so the totals of the
    day are not needed.
    """
    changed = changed.select("day", "area", "ads_id", "click_count")
    if before is None:
        return _largest(changed, k)
    old = (before.select(*changed.columns)
           .join(changed.select("day", "area").distinct(), ["day", "area"], "left_semi")
           .join(changed, ["day", "area", "ads_id"], "left_anti"))
    return _largest(changed.unionByName(old), k)


def area_ads_top3_json(top: DataFrame) -> DataFrame:
    """R4 serving form: (day, area, ads_json) with ``[{"ad":count},...]`` by rank.

    Each group holds at most k rows (the output of ``area_ads_top3``).
    """
    return (top.groupBy("day", "area")
            .agg(F.sort_array(F.collect_list(F.struct("rank", "ads_id", "click_count"))).alias("_l"))
            .select("day", "area", json_pairs(F.col("_l"), "ads_id", "click_count").alias("ads_json")))


# ---------------------------------------------------------------- R1 / R2

def blacklist_hits(clicks: DataFrame, threshold: int = BLACKLIST_THRESHOLD,
                   prior: DataFrame | None = None) -> DataFrame:
    """The click that makes a (user, day, ad) counter reach ``threshold``.

    One row per counter that reaches it: user_id, day, ads_id, ts[, event_id].
    ``prior`` (user_id, day, ads_id, n) gives counts from before ``clicks``
    (earlier micro-batches), so the hit is the click whose running count,
    prior included, first equals ``threshold``.  ``row_number() <= threshold``
    over the counter's clicks in time order is planned with a
    WindowGroupLimit: every task keeps at most ``threshold`` clicks per
    counter before the shuffle, so a hot user or ad sends a bounded number of
    rows to the final ranking.
    """
    keys = ["user_id", "day", "ads_id"]
    keep = [*keys, "ts"] + (["event_id"] if "event_id" in clicks.columns else [])
    w = Window.partitionBy(*keys).orderBy(*_time_order(clicks))
    ranked = (clicks.select(*keep)
              .withColumn("_n", F.row_number().over(w))
              .where(F.col("_n") <= threshold))
    if prior is None:
        return ranked.where(F.col("_n") == threshold).drop("_n")
    return (ranked.join(prior.select(*keys, F.col("n").alias("_p")), keys, "left")
            .where(F.col("_n") + F.coalesce(F.col("_p"), F.lit(0)) == threshold)
            .drop("_n", "_p"))


def blacklist_users(clicks: DataFrame, threshold: int = BLACKLIST_THRESHOLD) -> DataFrame:
    """Users with at least ``threshold`` clicks on one ad in one day.

    A plain grouped count (partial aggregation on the map side), then the
    distinct users of the counters at or over the threshold.
    """
    return (clicks.groupBy("user_id", "day", "ads_id").agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("n") >= threshold)
            .select("user_id").distinct())


def blacklist_since(clicks: DataFrame, threshold: int = BLACKLIST_THRESHOLD,
                    prior: DataFrame | None = None) -> DataFrame:
    """Per listed user, the (ts[, event_id]) of the click that listed them."""
    hits = blacklist_hits(clicks, threshold, prior)
    order = ["ts"] + (["event_id"] if "event_id" in hits.columns else [])
    first = F.min(F.struct(*order)).alias("_since")
    return hits.groupBy("user_id").agg(first).select(
        "user_id", *[F.col(f"_since.{c}").alias(f"listed_{c}") for c in order])


def ads_not_blacklisted(clicks: DataFrame, threshold: int = BLACKLIST_THRESHOLD, *,
                        prior: DataFrame | None = None) -> DataFrame:
    """R2 (row-exact): clicks that pass a blacklist updated after every click.

    A click passes unless its user was listed by an earlier click; the click
    that lists a user still passes (the filter runs before the update), as in
    the reference's filter-then-count order.  Equivalent to running the
    reference with a micro-batch of one click.  ``prior`` carries counter
    values from earlier batches (see ``blacklist_hits``); users listed before
    must already be removed from ``clicks``.

    Only the click's ids and time are read to find the listed users, so pass
    clicks that are not yet joined to their city.  No broadcast hint: AQE
    broadcasts the listed users if they turn out small, else the left join
    shuffles and AQE splits a hot user's partition.
    """
    since = blacklist_since(clicks, threshold, prior)
    c = clicks.alias("c")
    s = since.alias("s")
    cond = F.col("s.listed_ts").isNull() | (F.col("c.ts") < F.col("s.listed_ts"))
    if "event_id" in clicks.columns:
        cond = cond | ((F.col("c.ts") == F.col("s.listed_ts"))
                       & (F.col("c.event_id") <= F.col("s.listed_event_id")))
    else:
        cond = cond | (F.col("c.ts") == F.col("s.listed_ts"))
    return (c.join(s, F.col("c.user_id") == F.col("s.user_id"), "left")
            .where(cond).select("c.*"))


def drop_blacklisted(clicks: DataFrame, blacklist: DataFrame) -> DataFrame:
    """R2 (batch snapshot): drop clicks of users in ``blacklist`` (user_id).

    This is the reference's per-batch filter against the list as it stood
    when the batch began.  No broadcast hint: the list grows with the data,
    and AQE broadcasts it at run time only while it is small.
    """
    return clicks.join(blacklist.select("user_id"), "user_id", "left_anti")


# ---------------------------------------------------------------- R5

def last_hour_start(newest: Column, minutes: int = LAST_HOUR_MINUTES) -> Column:
    """First moment of the ``minutes`` whole minutes that end with the minute of ``newest``."""
    return F.date_trunc("minute", newest) - F.expr(f"INTERVAL {int(minutes) - 1} MINUTES")


def last_hour_ads(clicks: DataFrame, minutes: int = LAST_HOUR_MINUTES, now: Column | None = None) -> DataFrame:
    """Clicks per (ads_id, minute) over the last ``minutes`` whole minutes.

    The window is the ``minutes`` minutes that end with the minute of ``now``,
    which defaults to the newest click time (a scalar subquery, one small
    job); a stream's minute counts keep the same ones.  Columns: ads_id,
    minute_start (timestamp), minute ("HH:mm"), click_count.
    """
    if now is None:
        now = clicks.select(F.max("ts")).scalar()
    recent = clicks.where(F.col("ts") >= last_hour_start(now, minutes))
    start = F.date_trunc("minute", F.col("ts"))
    return (recent.groupBy("ads_id", start.alias("minute_start"))
            .agg(F.count(F.lit(1)).alias("click_count"))
            .select("ads_id", "minute_start",
                    F.date_format("minute_start", "HH:mm").alias("minute"), "click_count"))


def last_hour_json(per_minute: DataFrame) -> DataFrame:
    """R5 serving form: (ads_id, clicks_json) ``[{"HH:mm":count},...]`` by minute.

    A group holds at most one entry per minute of the window (60).
    """
    return (per_minute.groupBy("ads_id")
            .agg(F.sort_array(F.collect_list(F.struct("minute_start", "minute", "click_count"))).alias("_l"))
            .select("ads_id", json_pairs(F.col("_l"), "minute", "click_count").alias("clicks_json")))
