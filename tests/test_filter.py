from clickscope.config import Condition
from clickscope.operators.actions import filter_actions
from clickscope.operators.area import area_product_counts
from tests.helpers import action, actions_df, rows


def _users(spark):
    return spark.createDataFrame(
        [(1, "u1", "u1", 25, "eng", "M"), (2, "u2", "u2", 55, "art", "F")],
        "user_id long, username string, name string, age int, professional string, gender string")


def _acts(spark):
    return actions_df(spark, [action(1, user_id=1, date="2019-03-20"), action(2, user_id=2, date="2019-03-21"),
                              action(3, user_id=3, date="2019-03-22", click_product_id=1),
                              action(4, user_id=1, date="2019-03-25")])


def test_empty_condition_is_join_only(spark):
    got = filter_actions(_acts(spark), _users(spark), Condition(), ts_col=None)
    assert rows(got, "event_id") == [(1,), (2,), (4,)]


def test_dates_and_ages_inclusive(spark):
    c = Condition(start_date="2019-03-20", end_date="2019-03-21", start_age=20, end_age=55)
    assert rows(filter_actions(_acts(spark), _users(spark), c), "event_id") == [(1,), (2,)]
    c = Condition(start_age=30)
    assert rows(filter_actions(_acts(spark), _users(spark), c), "event_id") == [(2,)]


def test_optional_predicates(spark):
    c = Condition(professionals="art", gender="F")
    assert rows(filter_actions(_acts(spark), _users(spark), c), "event_id") == [(2,)]
    cities = spark.createDataFrame([(1, "C1", "north")], "city_id long, city_name string, area string")
    c = Condition(city="C1")
    assert len(rows(filter_actions(_acts(spark), _users(spark), c, cities=cities), "event_id")) == 3


def test_unknown_user_kept_by_area_report(spark):
    cities = spark.createDataFrame([(1, "C1", "north")], "city_id long, city_name string, area string")
    products = spark.createDataFrame([(1, "P1", "x")], "product_id long, product_name string, extend_info string")
    assert rows(area_product_counts(_acts(spark), cities, products), "product_name", "click_count") == [("P1", 1)]
