"""Page visits, page-to-page jumps along a target flow, conversion."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickscope.config import PAGE_RATE_PATTERN
from clickscope.functions.text import percent_sql
from clickscope.operators.adjacency import successor_counts


def _page_ids(flow: str) -> list[str]:
    # The reference splits the flow text on "," and compares the pieces with
    # page_id.toString, so only canonical decimal pieces can ever match.
    return [p for p in flow.split(",") if p.isdigit() and str(int(p)) == p]


def flow_pages(flow: str) -> list[int]:
    """Distinct pages of the flow, in order (last page included)."""
    seen: list[int] = []
    for p in _page_ids(flow):
        if int(p) not in seen:
            seen.append(int(p))
    return seen


def flow_pairs(flow: str) -> list[tuple[int, int]]:
    """Distinct adjacent pairs of the flow, in order.

    A pair listed twice is one result row (the reference keys it by text);
    a one-page flow has no pair.
    """
    pieces = flow.split(",")
    out: list[tuple[int, int]] = []
    for a, b in zip(pieces[:-1], pieces[1:]):
        ok = all(x.isdigit() and str(int(x)) == x for x in (a, b))
        if ok and (int(a), int(b)) not in out:
            out.append((int(a), int(b)))
    return out


def page_visit_counts(actions: DataFrame, flow: str) -> DataFrame:
    """(page_id, visits) for the pages of the flow."""
    pages = flow_pages(flow)
    return (actions.where(F.col("page_id").isin(pages))
            .groupBy("page_id").agg(F.count(F.lit(1)).alias("visits")))


def page_jump_counts(actions: DataFrame, flow: str, *, order: tuple[str, ...] = ("action_time", "event_id"),
                     skew_safe: bool = True) -> DataFrame:
    """(from_page, to_page, jumps) for adjacent flow pairs.

    Within a session, actions are ordered by ``order`` (time text, then the
    event id as tie-break); every two consecutive actions form a jump.  The
    successor is taken over *all* pages - a foreign page in between breaks a
    pair - and only then restricted to the flow's pairs.
    """
    pairs = flow_pairs(flow)
    if not pairs:
        schema = "from_page BIGINT, to_page BIGINT, jumps BIGINT"
        return actions.sparkSession.createDataFrame([], schema)
    order_cols = [c for c in order if c in actions.columns]
    counts = successor_counts(actions, "session_id", order_cols, "page_id", among=sorted({a for a, _ in pairs}), skew_safe=skew_safe)
    wanted = reduce(lambda x, y: x | y, [(F.col("value") == a) & (F.col("next_value") == b) for a, b in pairs])
    return counts.where(wanted).select(F.col("value").alias("from_page"), F.col("next_value").alias("to_page"), F.col("n").alias("jumps"))


def page_conversion(actions: DataFrame, flow: str, task_id: str | None = None, *,
                    order: tuple[str, ...] = ("action_time", "event_id"),
                    skew_safe: bool = True) -> DataFrame:
    """Conversion rate jumps(a-b) / visits(a) per flow pair.

    Columns: [task_id,] pair ("a-b"), jumps, visits, rate (text, pattern
    ".00%"), rate_value (double).  Pairs without any jump are absent.

    One pass over the log: every action gets its successor in the session,
    actions on flow pages are counted per (page, successor page) - a partial
    aggregation with at most |flow| x (pages + 1) groups - and both visits
    (sum over successors) and jumps (the flow pairs) come from that small
    table.
    """
    pairs = flow_pairs(flow)
    pages = flow_pages(flow)
    cols = ["task_id"] if task_id is not None else []
    schema = ", ".join([f"{c} STRING" for c in cols] +
                       ["pair STRING", "jumps BIGINT", "visits BIGINT", "rate STRING", "rate_value DOUBLE"])
    if not pairs:
        return actions.sparkSession.createDataFrame([], schema)
    order_cols = [c for c in order if c in actions.columns]
    stats = (successor_counts(actions, "session_id", order_cols, "page_id", among=pages, skew_safe=skew_safe)
             .withColumnRenamed("value", "page_id"))
    wanted = " OR ".join(f"(page_id = {a} AND next_value = {b})" for a, b in pairs)
    ratio = "jumps / visits"
    out = (stats.selectExpr("page_id", "next_value", "n",
                            "sum(n) OVER (PARTITION BY page_id) AS visits")
           .where(wanted)
           .selectExpr("concat_ws('-', CAST(page_id AS STRING), CAST(next_value AS STRING)) AS pair",
                       "n AS jumps", "CAST(visits AS BIGINT) AS visits")
           .selectExpr("pair", "jumps", "visits", f"{percent_sql(ratio, PAGE_RATE_PATTERN)} AS rate",
                       f"{ratio} AS rate_value"))
    if task_id is not None:
        out = out.select(F.lit(task_id).alias("task_id"), *out.columns)
    return out
