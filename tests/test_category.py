from clickscope.operators.category import (category_action_counts, category_session_top10,
                                           category_top10)
from tests.helpers import action, actions_df, rows


def test_click_wins_over_order(spark):
    df = actions_df(spark, [action(1, click_category_id=7, order_category_ids="3,4")])
    assert rows(category_action_counts(df), "category_id", "click_count", "order_count") == [("7", 1, 0)]


def test_duplicates_and_trailing_comma(spark):
    df = actions_df(spark, [action(1, order_category_ids="3,3,5"), action(2, order_category_ids="3,5,"),
                            action(3, pay_category_ids="5")])
    got = rows(category_action_counts(df), "category_id", "click_count", "order_count", "pay_count")
    assert got == [("3", 0, 3, 0), ("5", 0, 2, 1)]


def test_order_list_wins_over_pay_list(spark):
    df = actions_df(spark, [action(1, order_category_ids="2", pay_category_ids="9")])
    assert rows(category_action_counts(df), "category_id") == [("2",)]


def test_top10_order_and_ties(spark):
    data = [action(i, click_category_id=c) for i, c in enumerate([1, 1, 2, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12])]
    top = category_top10(category_action_counts(actions_df(spark, data)), n=10, task_id="t")
    got = [(r.category_id, r.click_count) for r in top.collect()]
    assert got[:2] == [("1", 2), ("2", 2)]
    # ties by id text: "10" < "11" < "12" < "3" ...
    assert [c for c, _ in got[2:]] == ["10", "11", "12", "3", "4", "5", "6", "7"]
    assert {r.task_id for r in top.collect()} == {"t"}


def test_session_top_k_is_exact_with_ties(spark):
    data = [action(i, session_id=f"s{i:02d}", click_category_id=1) for i in range(12)]
    df = actions_df(spark, data)
    top = category_top10(category_action_counts(df))
    got = category_session_top10(df, top, k=10)
    assert rows(got, "session_id") == [(f"s{i:02d}",) for i in range(10)]


def test_session_counts_most_first(spark):
    data = [action(1, session_id="a", click_category_id=1), action(2, session_id="b", click_category_id=1),
            action(3, session_id="b", click_category_id=1), action(4, session_id="c", click_category_id=2)]
    df = actions_df(spark, data)
    top = category_top10(category_action_counts(df))
    got = category_session_top10(df, top, k=1)
    assert rows(got, "category_id", "session_id", "click_count") == [("1", "b", 2), ("2", "c", 1)]


from hypothesis import given, settings, strategies as st  # noqa: E402


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 15), st.sampled_from(["click", "order", "pay"])), max_size=80),
       st.integers(1, 12))
def test_top_n_is_prefix_of_full_order(spark, acts, n):
    rows_ = []
    for i, (c, kind) in enumerate(acts):
        if kind == "click":
            rows_.append(action(i, click_category_id=c))
        elif kind == "order":
            rows_.append(action(i, order_category_ids=str(c)))
        else:
            rows_.append(action(i, pay_category_ids=str(c)))
    if not rows_:
        return
    counts = category_action_counts(actions_df(spark, rows_))
    full = [tuple(r) for r in category_top10(counts, n=1000).collect()]
    top = [tuple(r) for r in category_top10(counts, n=n).collect()]
    assert top == full[:n]
    keys = [(-r[1], -r[2], -r[3], r[0]) for r in full]
    assert keys == sorted(keys)


def test_sessions_and_totals_share_one_aggregate(spark):
    """The predicate that keeps both consumers of the shared aggregate alike must go on doing so."""
    from clickscope.plans.checks import QUERIES
    from tests.conftest import SF_SMALL
    df = QUERIES["category_session_top10"](spark, SF_SMALL)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "ReusedExchange" in plan and plan.count("Generate explode") == 1
