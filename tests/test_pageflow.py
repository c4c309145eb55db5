import random

import pytest
from pyspark.sql import functions as F
from hypothesis import given, settings, strategies as st

from clickscope.operators.adjacency import adjacent_pairs, successor_counts, with_successor
from clickscope.operators.pageflow import flow_pairs, page_conversion, page_jump_counts
from tests.helpers import action, actions_df, rows


def _session(spark, pages, sid="s1"):
    return actions_df(spark, [action(i, session_id=sid, page_id=p) for i, p in enumerate(pages)])


def test_foreign_page_breaks_pair(spark):
    assert page_jump_counts(_session(spark, [1, 9, 2]), "1,2").count() == 0


def test_repeated_visits(spark):
    got = page_conversion(_session(spark, [1, 2, 1, 2]), "1,2")
    assert rows(got, "pair", "jumps", "visits", "rate") == [("1-2", 2, 2, "100.00%")]


def test_small_rate_has_no_leading_zero(spark):
    data = [action(i, session_id=f"x{i}", page_id=1) for i in range(199)]
    data += [action(300, session_id="y", page_id=1), action(301, session_id="y", page_id=2)]
    got = page_conversion(actions_df(spark, data), "1,2")
    assert rows(got, "pair", "jumps", "visits", "rate") == [("1-2", 1, 200, ".50%")]


def test_one_page_flow_is_empty(spark):
    assert page_conversion(_session(spark, [1, 1, 1]), "1").count() == 0
    assert flow_pairs("1,2,1,2") == [(1, 2), (2, 1)]


def test_time_order_with_event_id_tie_break(spark):
    same = "2019-03-20 10:00:00"
    df = actions_df(spark, [action(2, page_id=2, action_time=same), action(1, page_id=1, action_time=same)])
    assert rows(page_jump_counts(df, "1,2"), "from_page", "to_page", "jumps") == [(1, 2, 1)]


def _brute_pairs(data):
    by = {}
    for sid, t, eid, page in data:
        by.setdefault(sid, []).append((t, eid, page))
    out = []
    for sid, items in by.items():
        items.sort()
        out += [(sid, a[2], b[2]) for a, b in zip(items, items[1:])]
    return sorted(out)


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["a", "b", "c"]), st.integers(0, 30), st.integers(1, 4)),
                min_size=0, max_size=60),
       st.sampled_from([None, "substr(_o0, 1, 2)", "substr(_o0, 1, 3)", "_o0", "''"]))
def test_bucketed_pairs_equal_brute_force(spark, events, bucket):
    data = [(sid, f"t{t:03d}", i, page) for i, (sid, t, page) in enumerate(events)]
    df = spark.createDataFrame(data, "session_id string, action_time string, event_id long, page_id long")
    got = adjacent_pairs(df, "session_id", ["action_time", "event_id"], "page_id", bucket=bucket)
    assert rows(got, "session_id", "prev_value", "next_value") == _brute_pairs(data)


@pytest.mark.parametrize("reuse", ["true", "false"])
@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_hot_session_is_split_and_stitched(spark, reuse, adaptive):
    random.seed(7)
    data = [("hot", f"2024-01-{1 + i // 480:02d} {i // 20 % 24:02d}:{i % 20:02d}", i, random.randint(1, 3)) for i in range(3000)]
    data += [(f"s{i}", f"2024-01-01 10:{i:02d}", 10_000 + i, 1) for i in range(50)] + [(None, "2024-01-01 1", 20_000, 1), (None, None, 20_001, 2)]
    df = spark.createDataFrame(data, "session_id string, action_time string, event_id long, page_id long").repartition(8)
    keys = {"spark.sql.exchange.reuse": reuse, "spark.sql.adaptive.enabled": adaptive, "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        succ = with_successor(df, "session_id", ["action_time", "event_id"], "page_id")
        tasks = [r[0] for r in succ.where("session_id = 'hot'").groupBy(F.spark_partition_id()).count().select("count").collect()]
        assert len(tasks) > 1 and sum(tasks) == 3000  # over several tasks
        got = sorted(map(tuple, succ.collect()), key=repr)
        plain = with_successor(df, "session_id", ["action_time", "event_id"], "page_id", skew_safe=False)
        assert got == sorted(map(tuple, plain.collect()), key=repr) and len(got) == len(data)
        counts = lambda **how: sorted(map(tuple, successor_counts(df, "session_id", ["action_time", "event_id"], "page_id",
                                                                  among=[1, 3], **how).collect()), key=repr)
        assert counts() == counts(skew_safe=False)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["a", "b"]), st.integers(1, 5)), max_size=40))
def test_jumps_never_exceed_visits(spark, events):
    data = [action(i, session_id=s, page_id=p) for i, (s, p) in enumerate(events)]
    if not data:
        return
    for r in page_conversion(actions_df(spark, data), "1,2,3,4,5").collect():
        assert r.jumps <= r.visits


@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_counts_of_successors_read_and_sort_the_log_once(spark, tmp_dir, adaptive):
    spark.range(50).selectExpr("concat('s', id % 3) AS session_id", "concat('2024-01-01 0', id % 7, ':', id) AS action_time", "id AS event_id",
                               "id % 4 AS page_id").write.parquet(f"{tmp_dir}/log")
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    try:
        df = page_conversion(spark.read.parquet(f"{tmp_dir}/log"), "1,2,3")
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        assert plan.count("FileScan parquet") == 1 and plan.count("ReusedExchange") >= 1
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
