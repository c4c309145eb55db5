import datetime as dt


from clickscope.operators import ads as A
from clickscope.sources.ads_log import kafka_options, parse_ads_log


def _clicks(spark, rows):
    return spark.createDataFrame(
        rows, "ts timestamp, event_id long, area string, city string, user_id string, ads_id string, day string")


def _t(m):
    return dt.datetime(2024, 1, 1, 10, 0) + dt.timedelta(minutes=m)


def test_parse_and_reject(spark):
    lines = spark.createDataFrame([("1704103200000,north,c1,7,3",), ("abc,x",), ("x,a,b,c,d",), ("1,a,b,c,",),
                                   ("99999999999999999,a,c,u,1",), ("-5,a,c,u,1",), (None,), ("",)], "value string")
    clicks, rejects = parse_ads_log(lines)
    got = clicks.collect()
    assert len(got) == 1 and got[0].user_id == "7" and got[0].ads_id == "3" and got[0].day == "2024-01-01"
    assert sorted(((r.value, r.reason) for r in rejects.collect()), key=repr) == sorted([
        ("1,a,b,c,", "too few fields"), ("abc,x", "too few fields"), ("x,a,b,c,d", "bad timestamp"), (None, "too few fields"),
        ("99999999999999999,a,c,u,1", "timestamp out of range"), ("-5,a,c,u,1", "timestamp out of range"),
        ("", "too few fields")], key=repr)


def test_kafka_options():
    o = kafka_options("h:9092", "ads_log", group_id="g")
    assert o["subscribe"] == "ads_log" and o["startingOffsets"] == "latest" and o["kafka.group.id"] == "g"
    assert o["failOnDataLoss"] == "true" and "maxOffsetsPerTrigger" not in o
    o = kafka_options("h:9092", "t", starting_offsets="earliest", max_offsets_per_trigger=10, fail_on_data_loss=False,
                      options={"kafka.security.protocol": "SSL"})
    assert (o["startingOffsets"], o["maxOffsetsPerTrigger"], o["failOnDataLoss"], o["kafka.security.protocol"]) == (
        "earliest", "10", "false", "SSL")


def test_blacklist_edge_row_mode(spark):
    rows = [(_t(i), i, "n", "c", "u1", "1", "2024-01-01") for i in range(6)]
    rows += [(_t(10), 10, "n", "c", "u2", "1", "2024-01-01")]
    clicks = _clicks(spark, rows)
    assert [r.user_id for r in A.blacklist_users(clicks, 4).collect()] == ["u1"]
    passed = sorted(r.event_id for r in A.ads_not_blacklisted(clicks, 4).collect())
    assert passed == [0, 1, 2, 3, 10]
    hits = A.blacklist_hits(clicks, 4).collect()
    assert [(h.user_id, h.event_id) for h in hits] == [("u1", 3)]


def test_blacklist_counts_per_day_and_ad(spark):
    rows = [(_t(i), i, "n", "c", "u1", str(i % 2 + 1), "2024-01-01") for i in range(6)]
    clicks = _clicks(spark, rows)
    assert A.blacklist_users(clicks, 4).count() == 0
    assert A.ads_not_blacklisted(clicks, 4).count() == 6


def test_top3_and_json(spark):
    rows = [("d", "n", "c1", "1", 150), ("d", "n", "c2", "1", 50), ("d", "n", "c1", "2", 100),
            ("d", "n", "c1", "3", 10), ("d", "n", "c1", "4", 10)]
    counts = spark.createDataFrame(rows, "day string, area string, city string, ads_id string, click_count long")
    top = A.area_ads_top3(counts, 3)
    assert sorted((r.ads_id, r.click_count, r.rank) for r in top.collect()) == [
        ("1", 200, 1), ("2", 100, 2), ("3", 10, 3)]
    assert A.area_ads_top3_json(top).first().ads_json == '[{"1":200},{"2":100},{"3":10}]'


def test_last_hour_window(spark):
    # the 60 minutes that end with 11:30: 10:30 is out, 10:31 is in
    rows = [(_t(30), 0, "n", "c", "u", "1", "d"), (_t(31), 1, "n", "c", "u", "1", "d"),
            (_t(90), 2, "n", "c", "u", "1", "d"), (_t(90), 3, "n", "c", "u", "2", "d")]
    got = A.last_hour_ads(_clicks(spark, rows))
    assert sorted((r.ads_id, r.minute, r.click_count) for r in got.collect()) == [
        ("1", "10:31", 1), ("1", "11:30", 1), ("2", "11:30", 1)]
    js = {r.ads_id: r.clicks_json for r in A.last_hour_json(got).collect()}
    assert js["1"] == '[{"10:31":1},{"11:30":1}]'


def test_last_hour_is_whole_minutes(spark):
    s30, s50 = (dt.datetime(2024, 1, 1, 11, 30, x) for x in (0, 50))
    rows = [(s30, 0, "n", "c", "u", "1", "d"), (s50, 1, "n", "c", "u", "1", "d"),
            (dt.datetime(2024, 1, 1, 12, 30, 20), 2, "n", "c", "u", "1", "d")]
    assert [(r.minute, r.click_count) for r in A.last_hour_ads(_clicks(spark, rows)).collect()] == [("12:30", 1)]


def test_drop_blacklisted_snapshot(spark):
    clicks = _clicks(spark, [(_t(0), 0, "n", "c", "u1", "1", "d"), (_t(1), 1, "n", "c", "u2", "1", "d")])
    bl = spark.createDataFrame([("u1",)], "user_id string")
    assert [r.user_id for r in A.drop_blacklisted(clicks, bl).collect()] == ["u2"]


from hypothesis import given, settings, strategies as st  # noqa: E402


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["u1", "u2", "u3"]), st.sampled_from(["1", "2"]),
                          st.integers(0, 3)), max_size=40), st.integers(1, 4))
def test_row_mode_output_is_subset_and_prefix(spark, events, th):
    rows = [(_t(i), i, "n", "c", u, a, f"2024-01-0{d + 1}") for i, (u, a, d) in enumerate(events)]
    if not rows:
        return
    clicks = _clicks(spark, rows)
    passed = {r.event_id for r in A.ads_not_blacklisted(clicks, th).collect()}
    assert passed <= {r[1] for r in rows}
    listed = {r.user_id for r in A.blacklist_users(clicks, th).collect()}
    for u in {r[4] for r in rows}:
        mine = [r[1] for r in rows if r[4] == u]
        kept = [e for e in mine if e in passed]
        assert kept == mine[:len(kept)]  # a user's passed clicks are a prefix in time
        if u not in listed:
            assert kept == mine
