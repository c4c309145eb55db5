"""The reports as named queries over the driver's test tables.

Each entry takes ``(spark, sf_dir)`` and returns a DataFrame computed over the
whole tables with the parameters of FIXTURES.md section 2.  The batch reports
are lazy, but for ``last_hour``, which reads the newest time first; the source,
sink and stream checks write and run their jobs when called.  Column
names equal those of the DuckDB twins in ``clickscope.plans.oracle``.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickscope.config import CHECK
from clickscope.functions.city_remark import register_city_remark
from clickscope.operators import ads as A
from clickscope.operators import area as AR
from clickscope.operators import category as C
from clickscope.operators import pageflow as P
from clickscope.operators.actions import filter_actions
from clickscope.schemas import ACTION_COLUMNS
from clickscope.sources import bindings as B

Query = Callable[[SparkSession, str], DataFrame]


def _filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = B.test_tables(spark, sf_dir)
    cities = B.cities(t) if CHECK.condition.city else None
    return filter_actions(B.actions(t), B.users(t), CHECK.condition, cities=cities, ts_col="ts")


def q_filter_actions(spark, sf_dir):
    return _filtered(spark, sf_dir).select("event_id", *ACTION_COLUMNS)


# B1x: the optional predicates the reference declares but never applies.
ATTRS = replace(CHECK.condition, professionals="BUILDING,MACHINERY", gender="F",
                city="NATION_3,NATION_7,NATION_11")
SEARCH = replace(CHECK.condition, keywords="kw_1,kw_4")
CATEGORIES = replace(CHECK.condition, category_ids="3,5,7")


def _filtered_with(spark, sf_dir, condition):
    t = B.test_tables(spark, sf_dir)
    return filter_actions(B.actions(t), B.users(t), condition, cities=B.cities(t), ts_col="ts").select(
        "event_id", *ACTION_COLUMNS)


def q_filter_actions_attrs(spark, sf_dir):
    return _filtered_with(spark, sf_dir, ATTRS)


def q_filter_actions_search(spark, sf_dir):
    return _filtered_with(spark, sf_dir, SEARCH)


def q_filter_actions_categories(spark, sf_dir):
    return _filtered_with(spark, sf_dir, CATEGORIES)


def q_category_counts(spark, sf_dir):
    return C.category_action_counts(_filtered(spark, sf_dir))


def q_category_top10(spark, sf_dir):
    return C.category_top10(C.category_action_counts(_filtered(spark, sf_dir)), task_id=CHECK.task_id)


def q_category_session_top10(spark, sf_dir):
    by_session = C.category_session_counts(_filtered(spark, sf_dir))
    top = C.category_top10(C.category_action_counts(None, by_session=by_session))
    return C.category_session_top10(None, top, task_id=CHECK.task_id, by_session=by_session)


def q_page_visits(spark, sf_dir):
    return P.page_visit_counts(_filtered(spark, sf_dir), CHECK.condition.target_page_flow)


def q_page_jumps(spark, sf_dir):
    return P.page_jump_counts(_filtered(spark, sf_dir), CHECK.condition.target_page_flow)


def q_page_conversion(spark, sf_dir):
    return P.page_conversion(_filtered(spark, sf_dir), CHECK.condition.target_page_flow,
                             task_id=CHECK.task_id)


def q_enrich_clicks(spark, sf_dir):
    t = B.test_tables(spark, sf_dir)
    return AR.enrich_clicks(B.actions(t), B.cities(t), B.products(t))


def q_area_product_counts(spark, sf_dir):
    t = B.test_tables(spark, sf_dir)
    return AR.area_product_counts(B.actions(t), B.cities(t), B.products(t),
                                  other_label=CHECK.other_label)


def q_area_product_counts_sql(spark, sf_dir):
    """B9/B10 through SQL text and the registered city_remark function."""
    t = B.test_tables(spark, sf_dir)
    tag = abs(hash((sf_dir, "area-sql"))) % 10**8
    views = {"clicks": B.actions(t), "city": B.cities(t), "product": B.products(t)}
    for name, df in views.items():
        df.createOrReplaceTempView(f"cs_{name}_{tag}")
    fn = register_city_remark(spark, CHECK.other_label)
    return spark.sql(f"""
        SELECT area, product_name, CAST(sum(n) AS BIGINT) AS click_count,
               {fn}(collect_list(named_struct('city', city_name, 'n', n))) AS city_remark
        FROM (SELECT c.area, p.product_name, c.city_name, count(*) AS n
              FROM cs_clicks_{tag} v
              JOIN cs_city_{tag} c ON v.city_id = c.city_id
              JOIN cs_product_{tag} p ON v.click_product_id = p.product_id
              WHERE v.click_product_id > -1
              GROUP BY c.area, p.product_name, c.city_name)
        GROUP BY area, product_name""")


def q_area_product_top3(spark, sf_dir):
    t = B.test_tables(spark, sf_dir)
    return AR.area_top_products(B.actions(t), B.cities(t), B.products(t),
                                other_label=CHECK.other_label)


def q_area_product_top3_sales(spark, sf_dir):
    t = B.test_tables(spark, sf_dir)
    return AR.area_top_products(B.sales_clicks(t), B.cities(t), B.products(t),
                                other_label=CHECK.other_label)


def _ads(spark, sf_dir):
    return B.ads_clicks(B.test_tables(spark, sf_dir))


def q_day_area_city_ads(spark, sf_dir):
    return A.day_area_city_ads(_ads(spark, sf_dir))


def q_area_ads_top3(spark, sf_dir):
    return A.area_ads_top3(A.day_area_city_ads(_ads(spark, sf_dir)))


def q_area_ads_top3_json(spark, sf_dir):
    return A.area_ads_top3_json(A.area_ads_top3(A.day_area_city_ads(_ads(spark, sf_dir))))


def q_blacklist(spark, sf_dir):
    return A.blacklist_users(_ads(spark, sf_dir), CHECK.blacklist_threshold)


def q_ads_not_blacklisted(spark, sf_dir):
    """The listed users are found on the bare log; only clicks that pass are joined to their city."""
    t = B.test_tables(spark, sf_dir)
    passed = A.ads_not_blacklisted(B.bare_clicks(t), CHECK.blacklist_threshold)
    return B.with_city(t, passed).select("event_id", "user_id", "ads_id", "day", "area", "city")


def _last_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R5 over the log's last hour: the newest time is read from the bare log (one column), and bounds the
    stored time, so that the scan skips what is older."""
    t = B.test_tables(spark, sf_dir)
    newest = t.events.select(F.max("ts").cast("string")).first()[0]
    now = F.lit(newest).cast("timestamp")
    since = A.last_hour_start(F.lit(newest).cast("timestamp_ntz")).cast("timestamp_ntz")
    recent = t.events.where(F.col("ts") >= since)
    return A.last_hour_ads(B.ads_clicks(t, recent), now=now)


def q_last_hour(spark, sf_dir):
    return _last_hour(spark, sf_dir).select("ads_id", "minute", "click_count")


def q_last_hour_json(spark, sf_dir):
    return A.last_hour_json(_last_hour(spark, sf_dir))


QUERIES: dict[str, Query] = {
    "filter_actions": q_filter_actions,
    "filter_actions_attrs": q_filter_actions_attrs,
    "filter_actions_search": q_filter_actions_search,
    "filter_actions_categories": q_filter_actions_categories,
    "category_counts": q_category_counts,
    "category_top10": q_category_top10,
    "category_session_top10": q_category_session_top10,
    "page_visits": q_page_visits,
    "page_jumps": q_page_jumps,
    "page_conversion": q_page_conversion,
    "enrich_clicks": q_enrich_clicks,
    "area_product_counts": q_area_product_counts,
    "area_product_counts_sql": q_area_product_counts_sql,
    "area_product_top3": q_area_product_top3,
    "area_product_top3_sales": q_area_product_top3_sales,
    "day_area_city_ads": q_day_area_city_ads,
    "area_ads_top3": q_area_ads_top3,
    "area_ads_top3_json": q_area_ads_top3_json,
    "blacklist": q_blacklist,
    "ads_not_blacklisted": q_ads_not_blacklisted,
    "last_hour": q_last_hour,
    "last_hour_json": q_last_hour_json,
}

from clickscope.plans.streams import STREAM_QUERIES  # noqa: E402
from clickscope.plans.tables import TABLE_QUERIES  # noqa: E402

QUERIES.update(STREAM_QUERIES)
QUERIES.update(TABLE_QUERIES)

# The ten report queries timed by bench.py (the survey's probe set).
HEADLINE = ["category_top10", "category_session_top10", "page_conversion", "area_product_top3",
            "area_product_top3_sales", "day_area_city_ads", "area_ads_top3", "blacklist",
            "ads_not_blacklisted", "last_hour"]
