"""Category funnel (click / order / pay counts), its top 10, and the
most active sessions of each top category."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickscope.config import TOP_CATEGORIES, TOP_SESSIONS
from clickscope.functions.text import split_id_list_sql


def _items(actions: DataFrame) -> DataFrame:
    """One row per counted (category, kind) of an action, keeping the session."""
    click = "coalesce(click_category_id, -1)"

    def tagged(col: str, kind: str) -> str:
        return (f"transform({split_id_list_sql(col)}, "
                f"x -> named_struct('category_id', x, 'kind', '{kind}'))")

    items = (f"CASE WHEN {click} <> -1 "
             f"THEN array(named_struct('category_id', CAST({click} AS STRING), 'kind', 'click')) "
             f"WHEN order_category_ids IS NOT NULL THEN {tagged('order_category_ids', 'order')} "
             f"WHEN pay_category_ids IS NOT NULL THEN {tagged('pay_category_ids', 'pay')} END")
    return (actions.selectExpr("session_id", f"explode({items}) AS it")
            .selectExpr("session_id", "it.category_id AS category_id", "it.kind AS kind"))


def _count_kinds(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(
        F.expr("count_if(kind = 'click')").alias("click_count"),
        F.expr("count_if(kind = 'order')").alias("order_count"),
        F.expr("count_if(kind = 'pay')").alias("pay_count"))


def category_session_counts(actions: DataFrame) -> DataFrame:
    """Click / order / pay counts per (category, session): one partial
    aggregation of the log from which both the category totals and the
    session ranking are derived, so the log is read once for B2-B4."""
    # Category ids are never NULL here; saying so keeps the two consumers
    # of this aggregate identical (a semi join would otherwise add the
    # filter on one side only), so Spark reuses one exchange for both.
    items = _items(actions).where(F.col("category_id").isNotNull())
    return _count_kinds(items, "category_id", "session_id")


def category_action_counts(actions: DataFrame, *, by_session: DataFrame | None = None) -> DataFrame:
    """B2: per category id (text), the number of click, order and pay actions.

    Per row, with else-if precedence: a click (click id != -1) counts once
    for its category; otherwise every piece of the order list counts as an
    order (duplicates count again); otherwise every piece of the pay list
    counts as a pay.  A NULL click id counts as -1.

    One ``explode`` and one grouped count: the aggregation is partial on the
    map side, so a hot category costs one counter per task before the
    shuffle.  Given ``by_session`` (``category_session_counts``) the totals
    are rolled up from it instead of reading the log again.
    """
    if by_session is not None:
        return by_session.groupBy("category_id").agg(
            *[F.sum(c).cast("bigint").alias(c) for c in ("click_count", "order_count", "pay_count")])
    return _count_kinds(_items(actions), "category_id")


def category_top10(counts: DataFrame, n: int = TOP_CATEGORIES,
                   task_id: str | None = None) -> DataFrame:
    """First ``n`` categories by click, order, pay counts (descending).

    Ties fall back to the category id text ascending.  Planned as a
    TakeOrderedAndProject: every task keeps its own top n, one final merge.
    """
    top = counts.orderBy(F.desc("click_count"), F.desc("order_count"), F.desc("pay_count"),
                         F.asc("category_id")).limit(n)
    if task_id is not None:
        top = top.select(F.lit(task_id).alias("task_id"), *counts.columns)
    return top


def category_session_top10(actions: DataFrame | None, top_categories: DataFrame,
                           k: int = TOP_SESSIONS, task_id: str | None = None, *,
                           by_session: DataFrame | None = None) -> DataFrame:
    """For each top category, the ``k`` sessions with most clicks on it.

    Exactly ``k`` rows per category (row_number; ties by session id text);
    only sessions with at least one click on the category.
    ``top_categories`` has at most n rows by construction (a limit), so it is
    broadcast without a check.  The per-category window is preceded by a
    partial WindowGroupLimit, so a category holding most sessions sends at
    most ``k`` rows per task into the final ranking.  With ``by_session``
    the clicks per (category, session) come from that shared aggregate.
    """
    ids = F.broadcast(top_categories.select("category_id").distinct())
    if by_session is not None:
        # Both consumers of ``by_session`` must plan the same aggregate for
        # Spark to run it once: an inner join with the (distinct, broadcast)
        # ids keeps the rows a semi join keeps but is not pushed below the
        # aggregate, and the order / pay counts stay referenced (counts are
        # never negative) so column pruning does not drop them on this side.
        counts = (by_session.join(ids, "category_id")
                  .where((F.col("click_count") > 0) & (F.col("order_count") + F.col("pay_count") >= 0))
                  .select("category_id", "session_id", "click_count"))
    else:
        clicks = actions.select(F.col("click_category_id").cast("string").alias("category_id"),
                                F.col("session_id"))
        counts = (clicks.join(ids, "category_id", "left_semi")
                  .groupBy("category_id", "session_id")
                  .agg(F.count(F.lit(1)).alias("click_count")))
    w = Window.partitionBy("category_id").orderBy(F.desc("click_count"), F.asc("session_id"))
    out = (counts.withColumn("_rn", F.row_number().over(w))
           .where(F.col("_rn") <= k).drop("_rn"))
    if task_id is not None:
        out = out.select(F.lit(task_id).alias("task_id"), "category_id", "session_id", "click_count")
    return out
