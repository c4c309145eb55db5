"""B1 / B1x: restrict the action log by user attributes and dates."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickscope.config import Condition


def _pieces(text: str) -> list[str]:
    return [p for p in (x.strip() for x in text.split(",")) if p]


def _all(preds: list[Column]) -> Column | None:
    return reduce(lambda a, b: a & b, preds) if preds else None


def filter_actions(actions: DataFrame, users: DataFrame, condition: Condition, *,
                   cities: DataFrame | None = None, ts_col: str | None = None) -> DataFrame:
    """Actions of users that exist and match the condition (all action columns).

    Only predicates that are set are added (empty text / zero age = none),
    exactly as the reference composes its SQL.  User predicates are applied
    to the user dimension before the join, and the join is a semi join on the
    user key: action rows are never widened, and a user key is unique in the
    dimension, so this equals the reference's inner join.

    Dates are ``yyyy-MM-dd`` text compared as text.  If the caller names the
    column of the stored event time (``ts_col``), the same range is added on it
    so that the Parquet scan can skip row groups; on a log partitioned by
    ``date`` the text predicates prune partitions directly.

    The optional fields (B1x) are comma lists: ``professionals``, ``gender``
    (on users), ``keywords`` (search_keyword), ``category_ids``
    (click_category_id) and ``city`` (city_name, needs ``cities``).
    """
    c = condition
    upreds: list[Column] = []
    if c.start_age:
        upreds.append(F.col("age") >= c.start_age)
    if c.end_age:
        upreds.append(F.col("age") <= c.end_age)
    if c.professionals:
        upreds.append(F.col("professional").isin(_pieces(c.professionals)))
    if c.gender:
        upreds.append(F.col("gender").isin(_pieces(c.gender)))
    u = users
    if upreds:
        u = u.where(_all(upreds))
    u = u.select("user_id")

    apreds: list[Column] = []
    has_ts = ts_col is not None
    if c.start_date:
        apreds.append(F.col("date") >= c.start_date)
        if has_ts:
            apreds.append(F.col(ts_col) >= F.to_timestamp(F.lit(c.start_date)).cast(
                actions.schema[ts_col].dataType))
    if c.end_date:
        apreds.append(F.col("date") <= c.end_date)
        if has_ts:
            apreds.append(F.col(ts_col) < F.date_add(F.to_date(F.lit(c.end_date)), 1).cast(
                actions.schema[ts_col].dataType))
    if c.keywords:
        apreds.append(F.col("search_keyword").isin(_pieces(c.keywords)))
    if c.category_ids:
        apreds.append(F.col("click_category_id").cast("string").isin(_pieces(c.category_ids)))
    a = actions.where(_all(apreds)) if apreds else actions

    if c.city:
        if cities is None:
            raise ValueError("condition.city needs the city dimension")
        wanted = cities.where(F.col("city_name").isin(_pieces(c.city))).select("city_id")
        a = a.join(wanted, "city_id", "left_semi")

    # No hint on users: the dimension grows with the data.  Spark broadcasts
    # it when its size is under the threshold (checked again by AQE at run
    # time); otherwise a shuffle semi join, where AQE splits a hot user.
    return a.join(u, "user_id", "left_semi")
