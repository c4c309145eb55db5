"""Clicks per area and product, with the city remark, top 3 per area."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickscope.config import CITY_SHARE_PATTERN, OTHER_LABEL, TOP_CITIES, TOP_PRODUCTS
from clickscope.functions.text import percent_sql

def _clicks(actions: DataFrame) -> DataFrame:
    return actions.where(F.coalesce(F.col("click_product_id"), F.lit(-1)) > -1)


def enrich_clicks(actions: DataFrame, cities: DataFrame, products: DataFrame) -> DataFrame:
    """B8 (row form): every click with its city and product (inner joins).

    Columns: city_id, city_name, area, click_product_id, product_name.  No
    broadcast hints: the planner and AQE choose by measured size.
    """
    c = cities.select("city_id", "city_name", "area")
    p = products.select("product_id", "product_name")
    return (_clicks(actions).select("city_id", "click_product_id")
            .join(c, "city_id")
            .join(p, F.col("click_product_id") == p["product_id"])
            .select("city_id", "city_name", "area", "click_product_id", "product_name"))


def area_city_product_counts(actions: DataFrame, cities: DataFrame, products: DataFrame) -> DataFrame:
    """B8+B9 first level: clicks per (area, product_name, city_name).

    The log is counted per (city_id, product_id) first, map-side combined, so
    the dimension joins see one row per distinct pair instead of one per
    click, and a hot product or city is collapsed before any shuffle.
    """
    pairs = (_clicks(actions).groupBy("city_id", "click_product_id").agg(F.count(F.lit(1)).alias("n")))
    c = cities.select("city_id", "city_name", "area")
    p = products.select("product_id", "product_name")
    return (pairs.join(c, "city_id")
            .join(p, F.col("click_product_id") == p["product_id"])
            .groupBy("area", "product_name", "city_name")
            .agg(F.sum("n").alias("n")))


def city_remark(per_city: DataFrame, group: list[str], *, city: str = "city_name", count: str = "n",
                top: int = TOP_CITIES, other_label: str = OTHER_LABEL,
                pattern: str = CITY_SHARE_PATTERN) -> DataFrame:
    """Per group, the total count and the city remark text.

    Input: one row per (group..., city) with its count.  Cities are ranked by
    count (descending, then name); the first ``top`` are named with their
    share of the group, and when the group has more than ``top`` cities an
    ``other_label`` entry carries ``1 - share1 - share2``.  The window runs
    over per-city counts (bounded by the number of cities of a group), and
    only ``top`` rows per group are collected.
    """
    keys = ", ".join(group)
    w_rank = f"OVER (PARTITION BY {keys} ORDER BY {count} DESC, {city} ASC)"
    w_all = f"OVER (PARTITION BY {keys})"
    ranked = per_city.selectExpr(*group, city, count, f"row_number() {w_rank} AS _rn",
                                 f"sum({count}) {w_all} AS _total", f"count(1) {w_all} AS _cities")
    named = (ranked.where(f"_rn <= {int(top)}")
             .selectExpr(*group, "_rn", "_total", "_cities", f"{count} / _total AS _share",
                         f"coalesce({city}, 'null') AS _city"))
    agg = (named.groupBy(*group)
           .agg(F.expr("max(_total)").alias("click_count"), F.expr("max(_cities)").alias("_cities"),
                F.expr("sort_array(collect_list(struct(_rn, _share AS share, _city AS city)))").alias("_top")))
    label = other_label.replace("'", "''")
    texts = f"transform(_top, e -> concat(e.city, ':', {percent_sql('e.share', pattern)}))"
    rest = "aggregate(_top, CAST(1.0 AS DOUBLE), (acc, e) -> acc - e.share)"
    other = (f"CASE WHEN _cities > {int(top)} THEN array(concat('{label}', ':', {percent_sql(rest, pattern)})) "
             f"ELSE CAST(array() AS ARRAY<STRING>) END")
    return agg.selectExpr(*group, "CAST(click_count AS BIGINT) AS click_count",
                          f"array_join(concat({texts}, {other}), ',') AS city_remark")


def area_product_counts(actions: DataFrame, cities: DataFrame, products: DataFrame, *,
                        other_label: str = OTHER_LABEL) -> DataFrame:
    """B9+B10: (area, product_name, click_count, city_remark)."""
    per_city = area_city_product_counts(actions, cities, products)
    return city_remark(per_city, ["area", "product_name"], other_label=other_label)


def area_product_top3(counts: DataFrame, k: int = TOP_PRODUCTS) -> DataFrame:
    """Products ranked by clicks inside their area, rank <= k, ties kept.

    ``rank`` (not row_number), so more than k rows per area are possible.
    The rank filter becomes a WindowGroupLimit: each task keeps only rows of
    rank <= k per area before the final window.
    """
    w = Window.partitionBy("area").orderBy(F.desc("click_count"))
    return (counts.withColumn("rank", F.rank().over(w).cast("bigint"))
            .where(F.col("rank") <= k))


def area_top_products(actions: DataFrame, cities: DataFrame, products: DataFrame, *,
                      k: int = TOP_PRODUCTS, other_label: str = OTHER_LABEL) -> DataFrame:
    """B8-B11 end to end: the area report over an (unfiltered) click log.

    Products are ranked by their totals first; only the survivors go back to
    their per-city counts for the remark.
    """
    per_city = area_city_product_counts(actions, cities, products)
    totals = per_city.groupBy("area", "product_name").agg(F.sum("n").alias("click_count"))
    top = area_product_top3(totals, k).select("area", "product_name", "rank")
    group = ["area", "product_name", "rank"]
    remarks = city_remark(per_city.join(top, ["area", "product_name"]), group, other_label=other_label)
    return remarks.select("area", "product_name", "click_count", "city_remark", "rank")
