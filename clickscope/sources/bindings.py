"""Binding of the driver's test tables to the data model (FIXTURES.md s.2).

The test data is a star schema plus an ``events`` table; these functions
derive the action log, the three dimensions, the ad-click log and a sales
variant of the click log from it.  Every expression here has a DuckDB twin in
``clickscope.plans.oracle``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickscope.sources.tables import ActionModel

TEST_TABLES = ("region", "nation", "customer", "supplier", "part", "orders",
               "lineitem", "events")

# One lazy DataFrame per (session, folder, table): a read resolves the file
# listing and footer once, like a catalog table, and later plans reuse it.
_READS: dict[tuple[int, str, str], DataFrame] = {}


@dataclass(frozen=True)
class TestTables:
    spark: SparkSession
    sf_dir: str

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TEST_TABLES:
            raise AttributeError(name)
        path = f"{self.sf_dir.rstrip('/')}/{name}.parquet"
        key = (id(self.spark), path, name)
        df = _READS.get(key)
        if df is None or df.sparkSession is not self.spark:
            df = self.spark.read.parquet(path)
            _READS[key] = df
        return df


def test_tables(spark: SparkSession, sf_dir: str) -> TestTables:
    return TestTables(spark, sf_dir)


# Shared SQL fragments of the binding (same text as the DuckDB twins).
K = "CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT)"
DATE = "CAST(CAST(ts AS DATE) AS STRING)"


def users(t: TestTables) -> DataFrame:
    return t.customer.selectExpr(
        "c_custkey AS user_id",
        "c_name AS username",
        "c_name AS name",
        "CAST(20 + c_custkey % 41 AS INT) AS age",
        "c_mktsegment AS professional",
        "CASE WHEN c_custkey % 10 < 6 THEN 'M' ELSE 'F' END AS gender",
    )


def cities(t: TestTables) -> DataFrame:
    """city_info: one row per TPC-H nation (25 rows by definition)."""
    return (t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
            .selectExpr("CAST(n_nationkey AS BIGINT) AS city_id", "n_name AS city_name",
                        "r_name AS area"))


def products(t: TestTables) -> DataFrame:
    return t.part.selectExpr("p_partkey AS product_id", "p_name AS product_name",
                             "p_type AS extend_info")


def actions(t: TestTables) -> DataFrame:
    """user_visit_action plus ``event_id`` (time tie-break) and ``ts``.

    ``ts`` lets date predicates also be stated on the stored timestamp, which
    the Parquet scan can push down (see ``filter_actions``).
    """
    e = t.events.selectExpr("event_id", "ts", "user_id", "event_type", f"{K} AS k")
    cust = t.customer.select("c_custkey", "c_nationkey")
    return (e.join(cust, e["user_id"] == cust["c_custkey"])
            .selectExpr(
                "event_id",
                "ts",
                f"{DATE} AS date",
                "user_id",
                f"CAST(user_id AS STRING) || '-' || {DATE} AS session_id",
                "k % 10 + 1 AS page_id",
                "CAST(ts AS STRING) AS action_time",
                "CASE WHEN event_type = 'view' THEN 'kw_' || CAST(k % 6 AS STRING) END AS search_keyword",
                "CAST(CASE WHEN event_type = 'click' THEN k % 20 + 1 ELSE -1 END AS BIGINT)"
                " AS click_category_id",
                "CAST(CASE WHEN event_type = 'click' THEN k ELSE -1 END AS BIGINT) AS click_product_id",
                "CASE WHEN event_type = 'purchase' THEN concat_ws(',', CAST(k % 20 + 1 AS STRING),"
                " CAST((k + event_id) % 20 + 1 AS STRING), CAST(event_id % 20 + 1 AS STRING)) END"
                " AS order_category_ids",
                "CASE WHEN event_type = 'purchase' THEN CAST(k AS STRING) END AS order_product_ids",
                "CASE WHEN event_type = 'signup' THEN concat_ws(',', CAST(k % 20 + 1 AS STRING),"
                " CAST((k + event_id) % 20 + 1 AS STRING)) END AS pay_category_ids",
                "CASE WHEN event_type = 'signup' THEN CAST(k AS STRING) END AS pay_product_ids",
                "CAST(c_nationkey AS BIGINT) AS city_id",
            ))


def action_model(t: TestTables) -> ActionModel:
    return ActionModel(actions=actions(t), users=users(t), cities=cities(t), products=products(t))


def sales_clicks(t: TestTables) -> DataFrame:
    """Sales variant of the click log: one lineitem = one click.

    city = nation of the ordering customer, product = part.  Only the two
    columns the area report reads are produced.  Orders are resolved to their
    customer's nation first, so the largest table (lineitem) takes part in one
    join only - at scale one shuffle by order key, never a second shuffle of
    the joined rows by customer key.
    """
    li = t.lineitem.select("l_orderkey", "l_partkey")
    c = t.customer.select("c_custkey", "c_nationkey")
    order_nation = (t.orders.select("o_orderkey", "o_custkey")
                    .join(c, F.col("o_custkey") == c["c_custkey"])
                    .select("o_orderkey", "c_nationkey"))
    return (li.join(order_nation, li["l_orderkey"] == order_nation["o_orderkey"])
            .selectExpr("CAST(c_nationkey AS BIGINT) AS city_id", "l_partkey AS click_product_id"))


def events_stream(t: TestTables, folder: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """A folder of event files as a file stream (same schema as the batch read)."""
    reader = t.spark.readStream.schema(t.events.schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.parquet(folder)


def bare_clicks(t: TestTables, events: DataFrame | None = None) -> DataFrame:
    """The ad-click log without its city: ts, event_id, user_id, ads_id, day and the customer key."""
    return (t.events if events is None else events).selectExpr(
        "CAST(ts AS TIMESTAMP) AS ts", "event_id", "user_id AS _cust", "CAST(user_id AS STRING) AS user_id",
        f"CAST({K} % 5 + 1 AS STRING) AS ads_id", f"{DATE} AS day")


def with_city(t: TestTables, clicks: DataFrame) -> DataFrame:
    """Bare clicks joined to area and city (TPC-H's nation table: 25 rows, so it is broadcast)."""
    cust = t.customer.select("c_custkey", "c_nationkey")
    city = cities(t)
    return (clicks.join(cust, clicks["_cust"] == cust["c_custkey"])
            .join(F.broadcast(city), F.col("c_nationkey").cast("bigint") == city["city_id"])
            .select("ts", "event_id", "area", F.col("city_name").alias("city"), "user_id", "ads_id", "day"))


# SQL text of a click log line: seven in ten are sound, the others broken in three ways.
LINE = ("CASE event_id % 10 WHEN 7 THEN 'abc,' || area || ',' || city || ',' || user_id || ',' || ads_id "
        "WHEN 8 THEN '99999999999999999,' || area || ',' || city || ',' || user_id || ',' || ads_id "
        "WHEN 9 THEN area || ',' || user_id "
        "ELSE CAST({ms} AS STRING) || ',' || area || ',' || city || ',' || user_id || ',' || ads_id END")


def ads_lines(t: TestTables) -> DataFrame:
    """(value, ts): one CSV line for every event, some of them malformed."""
    return ads_clicks(t).selectExpr(f"{LINE.format(ms='unix_millis(ts)')} AS value", "ts")


def ads_clicks(t: TestTables, events: DataFrame | None = None) -> DataFrame:
    """The ad-click log as parsed records: every event is one ad click.

    Columns: ts (timestamp, session zone; wall clock of the stored value),
    event_id, area, city, user_id (string), ads_id (string), day.
    ``events`` may be a streaming frame (stream-static joins).
    """
    return with_city(t, bare_clicks(t, events))
