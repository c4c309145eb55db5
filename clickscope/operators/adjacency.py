"""Successor of each row in order inside a group, safe for hot groups.

``lead`` over ``Window.partitionBy(group)`` sends a whole group to one task;
if one group (say one robot session) holds a third of the log, that task holds
a third of the work.  Here a group is cut by a value in its rows: a *bucket*
of the first order column (the hour of a time).  ``lead`` runs inside each
(group, bucket); the last row of a bucket is followed by the first row of the
group's next bucket, found in a table with one row per (group, bucket).  The
rows are shuffled once, by (group, bucket), and nothing depends on how Spark
happens to deal or reuse partitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _default_bucket(kind: T.DataType) -> str:
    """Hour of a time, or of a time in text (``yyyy-MM-dd HH``); one bucket for other types."""
    if isinstance(kind, T.StringType):
        return "substr(_o0, 1, 13)"
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return "CAST(date_trunc('HOUR', _o0) AS STRING)"
    return "''"


def with_successor(df: DataFrame, group: str, order: list[str], value: str, *,
                   bucket: str | None = None, skew_safe: bool = True) -> DataFrame:
    """Rows ``(group, value, next_value, has_next)``, one per input row.

    ``next_value`` is the ``value`` of the next row of the same group in
    ``order`` (NULL and ``has_next`` false for the last row).  ``order``
    must order the rows of a group totally (add a unique tie-break column).
    ``bucket`` is SQL text over ``_o0``, the first order column, that never
    decreases along it (default: its hour); it should cut a group into pieces
    that fit a task.
    """
    # columns are renamed to fixed names inside, so the SQL text below never
    # depends on how the caller's columns are spelled
    names = ["_g", *[f"_o{i}" for i in range(len(order))], "_v"]
    base = df.select(group, *order, value).toDF(*names)
    by = ", ".join(names[1:-1])
    if not skew_safe:
        w = f"OVER (PARTITION BY _g ORDER BY {by})"
        return base.selectExpr(f"_g AS `{group}`", f"_v AS `{value}`", f"lead(_v) {w} AS next_value",
                               f"lead(true) {w} IS NOT NULL AS has_next")

    cut = bucket or _default_bucket(base.schema["_o0"].dataType)
    base = base.selectExpr("*", f"coalesce({cut}, '') AS _b")
    w = f"OVER (PARTITION BY _g, _b ORDER BY {by})"
    inside = base.selectExpr("_g", "_b", "_v", f"lead(_v) {w} AS _next", f"lead(true) {w} IS NOT NULL AS _has_next")

    # one row per (group, bucket), pre-aggregated where the rows lie
    firsts = base.groupBy("_g", "_b").agg(F.expr(f"min(struct({by}, _v))").alias("_f"))
    w2 = "OVER (PARTITION BY _g ORDER BY _b)"
    follow = firsts.selectExpr("_g AS _fg", "_b AS _fb", f"lead(_f._v) {w2} AS _next_v",
                               f"lead(true) {w2} IS NOT NULL AS _goes_on")
    return (inside.join(follow, F.col("_g").eqNullSafe(F.col("_fg")) & (F.col("_b") == F.col("_fb")))
            .selectExpr(f"_g AS `{group}`", f"_v AS `{value}`",
                        "CASE WHEN _has_next THEN _next WHEN _goes_on THEN _next_v END AS next_value",
                        "_has_next OR _goes_on AS has_next"))


def successor_counts(df: DataFrame, group: str, order: list[str], value: str, *, among: list[int],
                     bucket: str | None = None, skew_safe: bool = True) -> DataFrame:
    """Rows ``(value, next_value, n)``: how often a value ``among`` these is followed by which (NULL: by nothing).

    The counts of ``with_successor`` without its second look at the rows.  One
    window over (group, bucket) gives each row its follower; the last row of a
    bucket keeps its group, its bucket and the bucket's first value instead.
    All are counted together: pairs inside buckets collapse where they lie, one
    row a (group, bucket) stays, and among those the first value of the group's
    next bucket is the missing follower.  Both parts read the same aggregate.
    """
    kept = ", ".join(str(int(v)) for v in among) or "NULL"
    if not skew_safe:
        rows = with_successor(df, group, order, value, skew_safe=False)
        return rows.where(f"`{value}` IN ({kept})").groupBy(F.col(value).alias("value"), "next_value").agg(F.count(F.lit(1)).alias("n"))
    names = ["_g", *[f"_o{i}" for i in range(len(order))], "_v"]
    base = df.select(group, *order, value).toDF(*names)
    cut = bucket or _default_bucket(base.schema["_o0"].dataType)
    w = f"OVER (PARTITION BY _g, _b ORDER BY {', '.join(names[1:-1])})"
    rows = (base.selectExpr("*", f"coalesce({cut}, '') AS _b")
            .selectExpr("_g", "_b", "_v", f"lead(_v) {w} AS _next", f"lead(true) {w} IS NULL AS _last", f"first_value(_v) {w} AS _first")
            .where(f"_last OR _v IN ({kept})")
            .selectExpr("_v", "_last", "CASE WHEN _last THEN _first ELSE _next END AS _w", "CASE WHEN _last THEN _g END AS _g",
                        "CASE WHEN _last THEN _b END AS _b"))
    # the flag is an aggregate, not a key: a filter on it stays above the exchange, which both parts then share
    counted = rows.groupBy("_v", "_w", "_g", "_b").agg(F.count(F.lit(1)).alias("n"), F.max("_last").alias("_end"))
    inside = counted.where("NOT _end").selectExpr("_v AS value", "_w AS next_value", "n")
    ends = (counted.where("_end").selectExpr("_v AS value", "lead(_w) OVER (PARTITION BY _g ORDER BY _b) AS next_value", "n")
            .where(f"value IN ({kept})"))
    return inside.unionByName(ends).groupBy("value", "next_value").agg(F.sum("n").alias("n"))


def adjacent_pairs(df: DataFrame, group: str, order: list[str], value: str, *,
                   bucket: str | None = None, skew_safe: bool = True) -> DataFrame:
    """Rows ``(group, prev_value, next_value)``: one per adjacent pair."""
    return (with_successor(df, group, order, value, bucket=bucket, skew_safe=skew_safe)
            .where("has_next")
            .selectExpr(f"`{group}`", f"`{value}` AS prev_value", "next_value"))
