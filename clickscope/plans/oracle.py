"""DuckDB twins of the named queries (driver correctness gate).

Plain SQL over the pre-registered test tables, written from the report
definitions, independent of the Spark code.  Percent text: DuckDB
``printf('%.2f%%', x * 100)`` equals ``format_number(x, '0.00%')``, and with
a leading "0" removed equals the ".00%" pattern.
"""

from __future__ import annotations

from clickscope.config import CHECK
from clickscope.plans.streams import PART_DATES

_C = CHECK.condition
_T = CHECK.task_id
_OTHER = CHECK.other_label
_TH = CHECK.blacklist_threshold

_EV = "(SELECT *, CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS k FROM events)"

_BASE = f"""
ui AS (
  SELECT c_custkey AS user_id, c_name AS username, c_name AS name,
         CAST(20 + c_custkey % 41 AS INTEGER) AS age, c_mktsegment AS professional,
         CASE WHEN c_custkey % 10 < 6 THEN 'M' ELSE 'F' END AS gender
  FROM customer),
ci AS (
  SELECT CAST(n_nationkey AS BIGINT) AS city_id, n_name AS city_name, r_name AS area
  FROM nation JOIN region ON n_regionkey = r_regionkey),
pi AS (SELECT p_partkey AS product_id, p_name AS product_name, p_type AS extend_info FROM part),
uva AS (
  SELECT e.event_id,
         CAST(CAST(e.ts AS DATE) AS VARCHAR) AS date,
         e.user_id,
         CAST(e.user_id AS VARCHAR) || '-' || CAST(CAST(e.ts AS DATE) AS VARCHAR) AS session_id,
         e.k % 10 + 1 AS page_id,
         CAST(e.ts AS VARCHAR) AS action_time,
         CASE WHEN e.event_type = 'view' THEN 'kw_' || CAST(e.k % 6 AS VARCHAR) END AS search_keyword,
         CAST(CASE WHEN e.event_type = 'click' THEN e.k % 20 + 1 ELSE -1 END AS BIGINT) AS click_category_id,
         CAST(CASE WHEN e.event_type = 'click' THEN e.k ELSE -1 END AS BIGINT) AS click_product_id,
         CASE WHEN e.event_type = 'purchase' THEN concat_ws(',', CAST(e.k % 20 + 1 AS VARCHAR),
              CAST((e.k + e.event_id) % 20 + 1 AS VARCHAR), CAST(e.event_id % 20 + 1 AS VARCHAR)) END
           AS order_category_ids,
         CASE WHEN e.event_type = 'purchase' THEN CAST(e.k AS VARCHAR) END AS order_product_ids,
         CASE WHEN e.event_type = 'signup' THEN concat_ws(',', CAST(e.k % 20 + 1 AS VARCHAR),
              CAST((e.k + e.event_id) % 20 + 1 AS VARCHAR)) END AS pay_category_ids,
         CASE WHEN e.event_type = 'signup' THEN CAST(e.k AS VARCHAR) END AS pay_product_ids,
         CAST(c.c_nationkey AS BIGINT) AS city_id
  FROM {_EV} e JOIN customer c ON e.user_id = c.c_custkey),
fa AS (
  SELECT v.* FROM uva v JOIN ui u ON v.user_id = u.user_id
  WHERE v.date >= '{_C.start_date}' AND v.date <= '{_C.end_date}'
    AND u.age >= {_C.start_age} AND u.age <= {_C.end_age}),
ads AS (
  SELECT e.ts, e.event_id, ci.area, ci.city_name AS city, CAST(e.user_id AS VARCHAR) AS user_id,
         CAST(e.k % 5 + 1 AS VARCHAR) AS ads_id, CAST(CAST(e.ts AS DATE) AS VARCHAR) AS day
  FROM {_EV} e JOIN customer c ON e.user_id = c.c_custkey
  JOIN ci ON CAST(c.c_nationkey AS BIGINT) = ci.city_id)
"""

def _fa_with(extra: str) -> str:
    return f"""
SELECT v.* FROM uva v JOIN ui u ON v.user_id = u.user_id
WHERE v.date >= '{_C.start_date}' AND v.date <= '{_C.end_date}'
  AND u.age >= {_C.start_age} AND u.age <= {_C.end_age} AND {extra}"""


_ATTRS = ("u.professional IN ('BUILDING', 'MACHINERY') AND u.gender IN ('F') AND v.city_id IN "
          "(SELECT city_id FROM ci WHERE city_name IN ('NATION_3', 'NATION_7', 'NATION_11'))")
_SEARCH = "v.search_keyword IN ('kw_1', 'kw_4')"
_CATEGORIES = "CAST(v.click_category_id AS VARCHAR) IN ('3', '5', '7')"

_CAT = """
items AS (
  SELECT CAST(click_category_id AS VARCHAR) AS category_id, 'click' AS kind
  FROM fa WHERE click_category_id <> -1
  UNION ALL
  SELECT unnest(string_split(regexp_replace(order_category_ids, ',+$', ''), ',')) AS category_id,
         'order' AS kind
  FROM fa WHERE click_category_id = -1 AND order_category_ids IS NOT NULL
  UNION ALL
  SELECT unnest(string_split(regexp_replace(pay_category_ids, ',+$', ''), ',')) AS category_id,
         'pay' AS kind
  FROM fa WHERE click_category_id = -1 AND order_category_ids IS NULL AND pay_category_ids IS NOT NULL),
cc AS (
  SELECT category_id,
         count(*) FILTER (WHERE kind = 'click') AS click_count,
         count(*) FILTER (WHERE kind = 'order') AS order_count,
         count(*) FILTER (WHERE kind = 'pay') AS pay_count
  FROM items GROUP BY category_id),
top AS (
  SELECT * FROM cc
  ORDER BY click_count DESC, order_count DESC, pay_count DESC, category_id LIMIT 10)
"""

# Pages and pairs of the flow 1,2,3,4,5,6,7 of the checks.
_PAGES = "1, 2, 3, 4, 5, 6, 7"
_PAIRS = "(prev_value, next_value) IN ((1, 2), (2, 3), (3, 4), (4, 5), (5, 6), (6, 7))"

_PAGE = f"""
pv AS (SELECT page_id, count(*) AS visits FROM fa WHERE page_id IN ({_PAGES}) GROUP BY page_id),
adj AS (
  SELECT page_id AS prev_value,
         lead(page_id) OVER (PARTITION BY session_id ORDER BY action_time, event_id) AS next_value
  FROM fa),
pj AS (
  SELECT prev_value AS from_page, next_value AS to_page, count(*) AS jumps
  FROM adj WHERE {_PAIRS} GROUP BY 1, 2)
"""


def _pct(x: str) -> str:
    return f"printf('%.2f%%', ({x}) * 100)"


def _area(clicks_sql: str) -> str:
    return f"""
clicks AS ({clicks_sql}),
pc AS (
  SELECT ci.area, pi.product_name, ci.city_name, count(*) AS n
  FROM clicks JOIN ci ON clicks.city_id = ci.city_id
  JOIN pi ON clicks.click_product_id = pi.product_id
  GROUP BY 1, 2, 3),
rk AS (
  SELECT *, row_number() OVER (PARTITION BY area, product_name ORDER BY n DESC, city_name) AS rn,
         CAST(sum(n) OVER (PARTITION BY area, product_name) AS BIGINT) AS total,
         count(*) OVER (PARTITION BY area, product_name) AS ncity
  FROM pc),
g AS (
  SELECT area, product_name, max(total) AS click_count, max(ncity) AS ncity,
         string_agg(city_name || ':' || {_pct('CAST(n AS DOUBLE) / total')}, ',' ORDER BY rn) AS named,
         (1.0 - max(CASE WHEN rn = 1 THEN CAST(n AS DOUBLE) / total END))
           - max(CASE WHEN rn = 2 THEN CAST(n AS DOUBLE) / total END) AS rest
  FROM rk WHERE rn <= 2 GROUP BY area, product_name),
apc AS (
  SELECT area, product_name, click_count,
         named || CASE WHEN ncity > 2 THEN ',{_OTHER}:' || {_pct('rest')} ELSE '' END AS city_remark
  FROM g)
"""


_UVA_CLICKS = "SELECT city_id, click_product_id FROM uva WHERE click_product_id > -1"
_SALES_CLICKS = ("SELECT CAST(c_nationkey AS BIGINT) AS city_id, l_partkey AS click_product_id "
                 "FROM lineitem JOIN orders ON l_orderkey = o_orderkey "
                 "JOIN customer ON o_custkey = c_custkey")

_TOP3 = """
SELECT * FROM (
  SELECT area, product_name, click_count, city_remark,
         CAST(rank() OVER (PARTITION BY area ORDER BY click_count DESC) AS BIGINT) AS rank
  FROM apc) WHERE rank <= 3
"""

_R3 = "r3 AS (SELECT day, area, city, ads_id, count(*) AS click_count FROM ads GROUP BY 1, 2, 3, 4)"
_R4 = f"""{_R3},
r4 AS (
  SELECT * FROM (
    SELECT day, area, ads_id, click_count,
           CAST(row_number() OVER (PARTITION BY day, area ORDER BY click_count DESC, ads_id) AS BIGINT) AS rank
    FROM (SELECT day, area, ads_id, CAST(sum(click_count) AS BIGINT) AS click_count
          FROM r3 GROUP BY 1, 2, 3)) WHERE rank <= 3)
"""

_HITS = f"""
hits AS (
  SELECT user_id, ts, event_id FROM (
    SELECT user_id, ts, event_id,
           row_number() OVER (PARTITION BY user_id, day, ads_id ORDER BY ts, event_id) AS rn
    FROM ads) WHERE rn = {_TH}),
since AS (
  SELECT user_id, ts AS lts, event_id AS leid FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS r FROM hits)
  WHERE r = 1)
"""

_LAST = """
lh AS (
  SELECT ads_id, date_trunc('minute', ts) AS minute_start, count(*) AS click_count
  FROM ads WHERE date_trunc('minute', ts) > (SELECT date_trunc('minute', max(ts)) FROM ads) - INTERVAL 60 MINUTE
  GROUP BY 1, 2)
"""

ORACLE_SQL: dict[str, str] = {
    "filter_actions": f"WITH {_BASE} SELECT * FROM fa",
    "filter_actions_attrs": f"WITH {_BASE} {_fa_with(_ATTRS)}",
    "filter_actions_search": f"WITH {_BASE} {_fa_with(_SEARCH)}",
    "filter_actions_categories": f"WITH {_BASE} {_fa_with(_CATEGORIES)}",
    "category_counts": f"WITH {_BASE}, {_CAT} SELECT * FROM cc",
    "category_top10": f"WITH {_BASE}, {_CAT} SELECT '{_T}' AS task_id, * FROM top",
    "category_session_top10": f"""WITH {_BASE}, {_CAT},
cs AS (
  SELECT CAST(click_category_id AS VARCHAR) AS category_id, session_id, count(*) AS click_count
  FROM fa WHERE CAST(click_category_id AS VARCHAR) IN (SELECT category_id FROM top)
  GROUP BY 1, 2)
SELECT '{_T}' AS task_id, category_id, session_id, click_count FROM (
  SELECT *, row_number() OVER (PARTITION BY category_id ORDER BY click_count DESC, session_id) AS rn
  FROM cs) WHERE rn <= 10""",
    "page_visits": f"WITH {_BASE}, {_PAGE} SELECT * FROM pv",
    "page_jumps": f"WITH {_BASE}, {_PAGE} SELECT * FROM pj",
    "page_conversion": f"""WITH {_BASE}, {_PAGE}
SELECT '{_T}' AS task_id, CAST(from_page AS VARCHAR) || '-' || CAST(to_page AS VARCHAR) AS pair,
       jumps, visits,
       regexp_replace({_pct('CAST(jumps AS DOUBLE) / visits')}, '^0\\.', '.') AS rate,
       CAST(jumps AS DOUBLE) / visits AS rate_value
FROM pj JOIN pv ON pj.from_page = pv.page_id""",
    "enrich_clicks": f"""WITH {_BASE}
SELECT ci.city_id, ci.city_name, ci.area, v.click_product_id, pi.product_name
FROM uva v JOIN ci ON v.city_id = ci.city_id JOIN pi ON v.click_product_id = pi.product_id
WHERE v.click_product_id > -1""",
    "area_product_counts": f"WITH {_BASE}, {_area(_UVA_CLICKS)} SELECT * FROM apc",
    "area_product_counts_sql": f"WITH {_BASE}, {_area(_UVA_CLICKS)} SELECT * FROM apc",
    "area_product_top3": f"WITH {_BASE}, {_area(_UVA_CLICKS)} {_TOP3}",
    "area_product_top3_sales": f"WITH {_BASE}, {_area(_SALES_CLICKS)} {_TOP3}",
    "day_area_city_ads": f"WITH {_BASE}, {_R3} SELECT * FROM r3",
    "area_ads_top3": f"WITH {_BASE}, {_R4} SELECT * FROM r4",
    "area_ads_top3_json": f"""WITH {_BASE}, {_R4}
SELECT day, area,
       '[' || string_agg('{{"' || ads_id || '":' || CAST(click_count AS VARCHAR) || '}}', ',' ORDER BY rank)
           || ']' AS ads_json
FROM r4 GROUP BY day, area""",
    "blacklist": f"""WITH {_BASE}
SELECT DISTINCT user_id FROM (
  SELECT user_id, day, ads_id, count(*) AS n FROM ads GROUP BY 1, 2, 3) WHERE n >= {_TH}""",
    "ads_not_blacklisted": f"""WITH {_BASE}, {_HITS}
SELECT a.event_id, a.user_id, a.ads_id, a.day, a.area, a.city
FROM ads a LEFT JOIN since s ON a.user_id = s.user_id
WHERE s.lts IS NULL OR a.ts < s.lts OR (a.ts = s.lts AND a.event_id <= s.leid)""",
    "last_hour": f"""WITH {_BASE}, {_LAST}
SELECT ads_id, strftime(minute_start, '%H:%M') AS minute, click_count FROM lh""",
    "last_hour_json": f"""WITH {_BASE}, {_LAST}
SELECT ads_id,
       '[' || string_agg('{{"' || strftime(minute_start, '%H:%M') || '":' || CAST(click_count AS VARCHAR)
           || '}}', ',' ORDER BY minute_start) || ']' AS clicks_json
FROM lh GROUP BY ads_id""",
}

# A CSV line of the click log, as sources.bindings makes it.
_LINES = f"""
lines AS (
  SELECT ts, user_id, ads_id, day, area, city, event_id,
         CASE event_id % 10 WHEN 7 THEN concat('abc,', area, ',', city, ',', user_id, ',', ads_id)
              WHEN 8 THEN concat('99999999999999999,', area, ',', city, ',', user_id, ',', ads_id)
              WHEN 9 THEN concat(area, ',', user_id)
              ELSE concat(epoch_ms(ts), ',', area, ',', city, ',', user_id, ',', ads_id) END AS value
  FROM ads),
sound AS (SELECT date_trunc('millisecond', ts) AS ts, area, city, user_id, ads_id, day
          FROM lines WHERE event_id % 10 < 7)
"""

# Micro-batches of the stream checks; a user is listed after the batch in
# which one of the user's counters reaches the threshold.
_PART = " + ".join(f"CASE WHEN day >= '{d}' THEN 1 ELSE 0 END" for d in PART_DATES)


def _snapshot(source: str) -> str:
    return f"""
parts AS (SELECT *, {_PART} AS part FROM {source}),
listed AS (
  SELECT user_id, min(part) AS part FROM (
    SELECT user_id, part, row_number() OVER (PARTITION BY user_id, day, ads_id ORDER BY ts) AS rn FROM parts)
  WHERE rn = {_TH} GROUP BY user_id),
passed AS (SELECT p.* FROM parts p LEFT JOIN listed l ON p.user_id = l.user_id WHERE l.part IS NULL OR p.part <= l.part)
"""


_CATEGORY_ROWS = "category_id, click_count, order_count, pay_count"

# The streaming jobs must end in the batch results.
ORACLE_SQL.update({
    "stream_day_area_city_ads": ORACLE_SQL["day_area_city_ads"],
    "stream_day_area_city_ads_expiring": ORACLE_SQL["day_area_city_ads"],
    "stream_area_ads_top3": ORACLE_SQL["area_ads_top3"],
    "stream_area_ads_top3_update": ORACLE_SQL["area_ads_top3"],
    "stream_area_ads_top3_json": ORACLE_SQL["area_ads_top3_json"],
    "stream_blacklist": ORACLE_SQL["blacklist"],
    "stream_blacklist_tables": ORACLE_SQL["blacklist"],
    "stream_blacklist_passed": f"WITH {_BASE}, {_snapshot('ads')} SELECT event_id, user_id, ads_id, day, area, city FROM passed",
    "stream_blacklist_passed_row": ORACLE_SQL["ads_not_blacklisted"],
    "stream_ads_not_blacklisted": ORACLE_SQL["ads_not_blacklisted"],
    "stream_last_hour": ORACLE_SQL["last_hour"],
    "stream_last_hour_json": ORACLE_SQL["last_hour_json"],
    "ads_pipeline": f"""WITH {_BASE}, {_LINES}, {_snapshot('sound')}
SELECT day, area, city, ads_id, count(*) AS click_count FROM passed GROUP BY 1, 2, 3, 4""",
    "ads_pipeline_rejects": f"""WITH {_BASE}, {_LINES}
SELECT value, CASE event_id % 10 WHEN 7 THEN 'bad timestamp' WHEN 8 THEN 'timestamp out of range' ELSE 'too few fields' END AS reason
FROM lines WHERE event_id % 10 >= 7""",
    "parse_ads_log": f"""WITH {_BASE}, {_LINES}
SELECT strftime(ts, '%Y-%m-%d %H:%M:%S.%g') AS ts, area, city, user_id, ads_id, day FROM sound""",
    "load_tables": ORACLE_SQL["area_product_top3"],
    "overwrite_table": ORACLE_SQL["category_counts"],
    "append_table": f"""WITH {_BASE}, {_CAT}
SELECT task_id, {_CATEGORY_ROWS} FROM cc, (SELECT unnest(['run-1', 'run-2']) AS task_id)""",
    "save_table": f"WITH {_BASE} SELECT * FROM uva",
})
ORACLE_SQL["parse_ads_log_rejects"] = ORACLE_SQL["ads_pipeline_rejects"]
