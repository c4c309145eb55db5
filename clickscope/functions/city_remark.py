"""The city remark - the two largest cities of a group with their share,
plus a residual entry when there are more cities.

Text form: ``NAME:12.34%,NAME:5.00%,other:82.66%``.  Shares use the
DecimalFormat pattern "0.00%"; the residual is ``(1 - share1) - share2``
computed in double, in that order, like the reference.

Two forms exist:

* the DataFrame form (``clickscope.operators.area.city_remark``) - a
  two-level aggregation (count per city, then rank cities in their group);
  it is the one the reports use;
* a SQL function over **per-city counts** registered by
  ``register_city_remark`` for SQL users::

      SELECT area, product_name, sum(n) AS click_count,
             city_remark(collect_list(named_struct('city', city_name, 'n', n)))
      FROM (SELECT area, product_name, city_name, count(*) AS n ... GROUP BY 1, 2, 3)
      GROUP BY area, product_name

  The reference's aggregate takes raw city names, one per row, and so holds
  a whole group in one buffer; here the argument is bounded by the number of
  cities of the group.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from clickscope.config import CITY_SHARE_PATTERN, TOP_CITIES


def city_remark_sql(arg: str, other_label: str, top: int = TOP_CITIES,
                    pattern: str = CITY_SHARE_PATTERN) -> str:
    """SQL expression of the remark over ``arg``: array<struct<city, n>>."""
    label = other_label.replace("'", "''")
    total = f"aggregate({arg}, 0L, (acc, e) -> acc + e.n)"
    ranked = (f"slice(array_sort({arg}, (a, b) -> CASE WHEN a.n > b.n THEN -1 WHEN a.n < b.n THEN 1 "
              f"WHEN a.city < b.city THEN -1 WHEN a.city > b.city THEN 1 ELSE 0 END), 1, {top})")
    shares = f"transform({ranked}, e -> named_struct('city', e.city, 'share', e.n / {total}))"
    named = (f"transform({shares}, s -> concat(coalesce(s.city, 'null'), ':', "
             f"format_number(s.share, '{pattern}')))")
    other = (f"CASE WHEN size({arg}) > {top} THEN array(concat('{label}', ':', "
             f"format_number(aggregate({shares}, 1D, (acc, s) -> acc - s.share), '{pattern}'))) "
             f"ELSE array() END")
    return f"array_join(concat({named}, {other}), ',')"


def register_city_remark(spark: SparkSession, other_label: str, name: str = "city_remark") -> str:
    """Register ``name(array<struct<city string, n bigint>>) -> string``."""
    body = city_remark_sql("counts", other_label)
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION {name}"
        f"(counts ARRAY<STRUCT<city: STRING, n: BIGINT>>) RETURNS STRING RETURN {body}")
    return name
