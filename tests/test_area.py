from hypothesis import given, settings, strategies as st

from clickscope.functions.city_remark import register_city_remark
from clickscope.operators.area import area_product_counts, area_product_top3, city_remark
from tests.helpers import action, actions_df, rows

CITIES = [(1, "C1", "north"), (2, "C2", "north"), (3, "C3", "north"), (4, "C4", "south")]


def _dims(spark):
    cities = spark.createDataFrame(CITIES, "city_id long, city_name string, area string")
    products = spark.createDataFrame([(p, f"P{p}", "x") for p in range(1, 8)],
                                     "product_id long, product_name string, extend_info string")
    return cities, products


def _clicks(spark, pairs):
    return actions_df(spark, [action(i, click_product_id=p, city_id=c) for i, (c, p) in enumerate(pairs)])


def test_remark_one_two_three_cities(spark):
    cities, products = _dims(spark)
    clicks = _clicks(spark, [(1, 1)] + [(1, 2), (2, 2), (2, 2)] + [(1, 3), (2, 3), (3, 3), (3, 3)])
    got = {r.product_name: r.city_remark
           for r in area_product_counts(clicks, cities, products, other_label="other").collect()}
    assert got["P1"] == "C1:100.00%"
    assert got["P2"] == "C2:66.67%,C1:33.33%"
    assert got["P3"] == "C3:50.00%,C1:25.00%,other:25.00%"


def test_unmatched_clicks_are_dropped(spark):
    cities, products = _dims(spark)
    clicks = _clicks(spark, [(1, 1), (99, 1), (1, 99)]).union(
        actions_df(spark, [action(50, click_product_id=-1, city_id=1)]))
    assert rows(area_product_counts(clicks, cities, products), "product_name", "click_count") == [("P1", 1)]


def test_rank_keeps_ties(spark):
    counts = spark.createDataFrame(
        [("north", "a", 5, ""), ("north", "b", 4, ""), ("north", "c", 3, ""), ("north", "d", 3, ""),
         ("north", "e", 2, "")], "area string, product_name string, click_count long, city_remark string")
    got = rows(area_product_top3(counts, 3), "product_name", "rank")
    assert got == [("a", 1), ("b", 2), ("c", 3), ("d", 3)]


def test_sql_function_equals_dataframe_form(spark):
    register_city_remark(spark, "other")
    data = [("g1", "A", 3), ("g1", "B", 3), ("g1", "C", 1), ("g2", "A", 2), ("g3", "Z", 1), ("g3", "Y", 1)]
    df = spark.createDataFrame(data, "g string, city_name string, n long")
    df.createOrReplaceTempView("per_city")
    sql = spark.sql("SELECT g, sum(n) AS click_count, "
                    "city_remark(collect_list(named_struct('city', city_name, 'n', n))) AS city_remark "
                    "FROM per_city GROUP BY g")
    native = city_remark(df, ["g"], other_label="other")
    assert rows(sql, "g", "click_count", "city_remark") == rows(native, "g", "click_count", "city_remark")


@settings(max_examples=10, deadline=None)
@given(st.lists(st.integers(1, 50), min_size=1, max_size=6))
def test_shares_sum_to_one(spark, counts):
    df = spark.createDataFrame([("g", f"c{i}", n) for i, n in enumerate(counts)],
                               "g string, city_name string, n long")
    text = city_remark(df, ["g"], other_label="o").first().city_remark
    total = sum(float(part.split(":")[1].rstrip("%")) for part in text.split(","))
    assert abs(total - 100.0) <= 0.02
    assert len(text.split(",")) == (3 if len(counts) > 2 else len(counts))


def test_ranking_first_gives_the_same_report(spark):
    from clickscope.operators.area import area_top_products
    from clickscope.sources import bindings as B
    from tests.conftest import SF_SMALL
    t = B.test_tables(spark, SF_SMALL)
    dims = (B.actions(t), B.cities(t), B.products(t))
    cols = ["area", "product_name", "click_count", "city_remark", "rank"]
    top = area_top_products(*dims, other_label="other")
    assert rows(top, *cols) == rows(area_product_top3(area_product_counts(*dims, other_label="other")), *cols)
    assert "WindowGroupLimit" in top._jdf.queryExecution().executedPlan().toString()
