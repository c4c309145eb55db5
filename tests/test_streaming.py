import datetime as dt
import os
import re
import time

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from clickscope.config import CHECK
from clickscope.operators import ads as A
from clickscope.session import checkpoint_root
from clickscope.sources import bindings as B
from clickscope.streaming import ads_jobs as J
from clickscope.streaming.keyed import CommitLog, KeyedTable, TableClaimed
from tests.conftest import SF_MID

TH = CHECK.blacklist_threshold


@pytest.fixture(scope="module")
def sliced(tmp_path_factory):
    """The events table cut into 4 files in event order (4 micro-batches)."""
    folder = tmp_path_factory.mktemp("events4")
    table = pq.read_table(f"{SF_MID}/events.parquet").sort_by("event_id")
    n = table.num_rows
    for i in range(4):
        path = folder / f"part-{i}.parquet"
        pq.write_table(table.slice(i * n // 4, (i + 1) * n // 4 - i * n // 4), path)
        os.utime(path, (time.time() + i, time.time() + i))
    return str(folder)


def _stream(spark, sliced):
    t = B.test_tables(spark, SF_MID)
    return B.ads_clicks(t, B.events_stream(t, max_files_per_trigger=1, folder=sliced))


def _batch(spark):
    return B.ads_clicks(B.test_tables(spark, SF_MID))


def _rows(df, cols):
    return sorted(tuple(r[c] for c in cols) for r in df.select(*cols).collect())


def _run(q):
    q.awaitTermination()
    assert q.exception() is None
    return q


@pytest.mark.parametrize("mode", ["complete", "update"])
def test_running_counts_and_top3_equal_batch(spark, sliced, tmp_dir, mode):
    q = _run(J.start_running_counts(_stream(spark, sliced), f"{tmp_dir}/out", f"{tmp_dir}/ck", mode=mode,
                                    trigger=J.AVAILABLE_NOW))
    assert len(q.recentProgress) >= 4
    r3 = _batch(spark).transform(A.day_area_city_ads)
    cols3 = ["day", "area", "city", "ads_id", "click_count"]
    assert _rows(J.read_table(spark, f"{tmp_dir}/out", "day_area_city_ads"), cols3) == _rows(r3, cols3)
    cols4 = ["day", "area", "ads_id", "click_count", "rank"]
    top = A.area_ads_top3(r3)
    assert _rows(J.read_table(spark, f"{tmp_dir}/out", "area_ads_top3"), cols4) == _rows(top, cols4)
    js = J.read_table(spark, f"{tmp_dir}/out", "area_ads_top3_json")
    assert _rows(js, ["day", "area", "ads_json"]) == _rows(A.area_ads_top3_json(top), ["day", "area", "ads_json"])


def test_last_hour_equals_batch_minutes(spark, sliced, tmp_dir):
    q = _run(J.start_last_hour(_stream(spark, sliced), f"{tmp_dir}/out", f"{tmp_dir}/ck",
                               trigger=J.AVAILABLE_NOW))
    dropped = sum(p["stateOperators"][0].get("numRowsDroppedByWatermark", 0) for p in q.recentProgress
                  if p.get("stateOperators"))
    assert dropped == 0
    clicks = _batch(spark)
    expected = A.last_hour_ads(clicks)
    cols = ["ads_id", "minute", "click_count"]
    assert _rows(J.read_last_hour(spark, f"{tmp_dir}/out"), cols) == _rows(expected, cols)
    js = {r.ads_id: r.clicks_json for r in J.read_last_hour_json(spark, f"{tmp_dir}/out").collect()}
    assert set(js) == {r.ads_id for r in expected.collect()}
    assert all(v.startswith('[{"') and v.endswith("}]") for v in js.values())


def test_blacklist_row_mode_equals_batch(spark, sliced, tmp_dir):
    _run(J.start_blacklist(_stream(spark, sliced), f"{tmp_dir}/out", f"{tmp_dir}/ck", threshold=TH,
                           mode="row", trigger=J.AVAILABLE_NOW))
    clicks = _batch(spark)
    assert _rows(J.read_passed_clicks(spark, f"{tmp_dir}/out"), ["event_id"]) == \
        _rows(A.ads_not_blacklisted(clicks, TH), ["event_id"])
    assert _rows(J.read_blacklist(spark, f"{tmp_dir}/out"), ["user_id"]) == \
        _rows(A.blacklist_users(clicks, TH), ["user_id"])


def test_blacklist_batch_mode_snapshot(spark, sliced, tmp_dir):
    _run(J.start_blacklist(_stream(spark, sliced), f"{tmp_dir}/out", f"{tmp_dir}/ck", threshold=TH,
                           mode="batch", trigger=J.AVAILABLE_NOW))
    clicks = _batch(spark)
    passed = {r[0] for r in _rows(J.read_passed_clicks(spark, f"{tmp_dir}/out"), ["event_id"])}
    exact = {r[0] for r in _rows(A.ads_not_blacklisted(clicks, TH), ["event_id"])}
    # a user may run over the threshold within one batch: batch mode passes more
    assert exact <= passed and len(passed) > len(exact)
    assert _rows(J.read_blacklist(spark, f"{tmp_dir}/out"), ["user_id"]) == \
        _rows(A.blacklist_users(clicks, TH), ["user_id"])


def test_jvm_blacklist_tables_equal_state_batch_mode(spark, sliced, tmp_dir):
    """Two implementations of the reference's snapshot semantics agree."""
    _run(J.start_blacklist_tables(_stream(spark, sliced), f"{tmp_dir}/a", f"{tmp_dir}/cka", threshold=TH,
                                  trigger=J.AVAILABLE_NOW))
    _run(J.start_blacklist(_stream(spark, sliced), f"{tmp_dir}/b", f"{tmp_dir}/ckb", threshold=TH,
                           mode="batch", trigger=J.AVAILABLE_NOW))
    listed, passed = J.read_blacklist_tables(spark, f"{tmp_dir}/a")
    assert _rows(passed, ["event_id"]) == _rows(J.read_passed_clicks(spark, f"{tmp_dir}/b"), ["event_id"])
    assert _rows(listed, ["user_id"]) == _rows(A.blacklist_users(_batch(spark), TH), ["user_id"])


def test_jvm_blacklist_tables_row_mode_equals_batch_operator(spark, sliced, tmp_dir):
    _run(J.start_blacklist_tables(_stream(spark, sliced), f"{tmp_dir}/a", f"{tmp_dir}/cka", threshold=TH,
                                  mode="row", trigger=J.AVAILABLE_NOW))
    listed, passed = J.read_blacklist_tables(spark, f"{tmp_dir}/a")
    clicks = _batch(spark)
    assert _rows(passed, ["event_id"]) == _rows(A.ads_not_blacklisted(clicks, TH), ["event_id"])
    assert _rows(listed, ["user_id"]) == _rows(A.blacklist_users(clicks, TH), ["user_id"])


@pytest.mark.parametrize("counts_mode", ["update", "complete"])
def test_composed_jobs_count_all_clicks(spark, sliced, tmp_dir, counts_mode):
    for q in J.start_ads_jobs(_stream(spark, sliced), f"{tmp_dir}/out", f"{tmp_dir}/ck", threshold=TH, counts_mode=counts_mode,
                              filter_blacklisted=False, trigger=J.AVAILABLE_NOW):
        _run(q)
    cols = ["day", "area", "city", "ads_id", "click_count"]
    assert _rows(J.read_table(spark, f"{tmp_dir}/out", "day_area_city_ads"), cols) == _rows(A.day_area_city_ads(_batch(spark)), cols)
    J.compact_tables(spark, f"{tmp_dir}/out")
    assert _rows(J.read_table(spark, f"{tmp_dir}/out", "day_area_city_ads"), cols) == _rows(A.day_area_city_ads(_batch(spark)), cols)


def test_composed_jobs_count_passed_clicks(spark, sliced, tmp_dir):
    qs = J.start_ads_jobs(_stream(spark, sliced), f"{tmp_dir}/out", f"{tmp_dir}/ck", threshold=TH,
                          blacklist_mode="row", trigger=J.AVAILABLE_NOW)
    for q in qs:
        _run(q)
    passed = A.ads_not_blacklisted(_batch(spark), TH)
    cols = ["day", "area", "city", "ads_id", "click_count"]
    assert _rows(J.read_table(spark, f"{tmp_dir}/out", "day_area_city_ads"), cols) == \
        _rows(A.day_area_city_ads(passed), cols)
    top = A.area_ads_top3(A.day_area_city_ads(passed))
    assert _rows(J.read_table(spark, f"{tmp_dir}/out", "area_ads_top3"), ["day", "area", "ads_id", "rank"]) == \
        _rows(top, ["day", "area", "ads_id", "rank"])
    cols = ["ads_id", "minute", "click_count"]
    assert _rows(J.read_last_hour(spark, f"{tmp_dir}/out"), cols) == _rows(A.last_hour_ads(passed), cols)


def _claimed(spark, tmp_dir, name, keys, part=None):
    t = KeyedTable(f"{tmp_dir}/{name}", keys, part)
    t.claim(spark, f"{tmp_dir}/ck")
    return t


def test_keyed_upsert_replay_is_idempotent(spark, tmp_dir):
    t = _claimed(spark, tmp_dir, "tbl", ["k"])
    assert t.read(spark) is None
    b0 = spark.createDataFrame([("a", 1), ("b", 1)], "k string, n long")
    b1 = spark.createDataFrame([("b", 5), ("c", 1)], "k string, n long")
    t.upsert(b0, 0)
    t.upsert(b1, 1)
    once = _rows(t.read(spark), ["k", "n"])
    t.upsert(b1, 1)
    assert _rows(t.read(spark), ["k", "n"]) == once == [("a", 1), ("b", 5), ("c", 1)]
    assert _rows(t.read(spark, below=1), ["k", "n"]) == [("a", 1), ("b", 1)]
    t.upsert(b0, 2)
    assert _rows(t.read(spark), ["k", "n"]) == [("a", 1), ("b", 1), ("c", 1)]


def test_all_rows_of_a_key_are_replaced(spark, tmp_dir):
    t = _claimed(spark, tmp_dir, "top", ["day"], "day")
    schema = "day string, ads string"
    t.upsert(spark.createDataFrame([("d1", "x"), ("d1", "y"), ("d2", "x")], schema), 0)
    t.upsert(spark.createDataFrame([("d1", "z")], schema), 1)
    assert _rows(t.read(spark), ["day", "ads"]) == [("d1", "z"), ("d2", "x")]


def test_partitioned_read_scans_only_its_days(spark, tmp_dir):
    t = _claimed(spark, tmp_dir, "ptbl", ["day", "k"], "day")
    schema = "day string, k string, n long"
    t.upsert(spark.createDataFrame([("2024-01-01", "a", 1), ("2024-01-02", "a", 1)], schema), 0)
    t.upsert(spark.createDataFrame([("2024-01-02", "a", 7), ("2024-01-02", "b", 1)], schema), 1)
    only = t.read(spark, only=spark.createDataFrame([("2024-01-02",)], "day string"))
    assert _rows(only, ["day", "k", "n"]) == [("2024-01-02", "a", 7), ("2024-01-02", "b", 1)]
    plan = only._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*_part[^\]]*2024-01-02", plan)
    assert _rows(t.read(spark), ["day", "k", "n"])[0] == ("2024-01-01", "a", 1)


def test_a_batch_from_another_checkpoint_is_refused(spark, tmp_dir):
    schema = "k string, n long"
    t = _claimed(spark, tmp_dir, "tbl", ["k"])
    for b in range(5):
        t.upsert(spark.createDataFrame([("a", b)], schema), b)
    with pytest.raises(TableClaimed):
        t.claim(spark, f"{tmp_dir}/other")
    t.claim(spark, f"{tmp_dir}/ck")  # the query itself restarts
    assert _rows(t.read(spark), ["k", "n"]) == [("a", 4)]
    t.claim(spark, f"{tmp_dir}/other", reset=True)
    t.upsert(spark.createDataFrame([("new", 1)], schema), 0)  # ids start again, nothing is lost
    assert _rows(t.read(spark), ["k", "n"]) == [("new", 1)]
    with pytest.raises(TableClaimed):
        KeyedTable(f"{tmp_dir}/unclaimed", ["k"]).upsert(spark.createDataFrame([("a", 1)], schema), 0)


def test_compaction_is_a_call_of_its_own(spark, tmp_dir):
    t = _claimed(spark, tmp_dir, "ctbl", ["day", "k"], "day")
    schema = "day string, k string, n long"
    for b in range(6):
        t.upsert(spark.createDataFrame([("2024-01-01" if b < 2 else "2024-01-02", "a", b)], schema), b)
    before = _rows(t.read(spark), ["day", "k", "n"])
    old = t.compact(spark)
    assert _rows(t.read(spark), ["day", "k", "n"]) == before == [("2024-01-01", "a", 1), ("2024-01-02", "a", 5)]
    assert old != t.data_path(spark) and os.listdir(t.data_path(spark)) == ["batch=5"]
    t.upsert(spark.createDataFrame([("2024-01-02", "a", 9)], schema), 6)
    assert _rows(t.read(spark), ["day", "k", "n"]) == [("2024-01-01", "a", 1), ("2024-01-02", "a", 9)]
    t.compact(spark, keep=F.col("day") > "2024-01-01")
    assert _rows(t.read(spark), ["day", "k", "n"]) == [("2024-01-02", "a", 9)]
    assert _claimed(spark, tmp_dir, "none", ["k"]).compact(spark) is None


def test_restart_with_another_checkpoint_needs_a_reset(spark, sliced, tmp_dir):
    def start(ck, **how):
        return J.start_running_counts(_stream(spark, sliced), f"{tmp_dir}/out", f"{tmp_dir}/{ck}", trigger=J.AVAILABLE_NOW, **how)
    cols = ["day", "area", "city", "ads_id", "click_count"]
    _run(start("a"))
    want = _rows(J.read_table(spark, f"{tmp_dir}/out", "day_area_city_ads"), cols)
    with pytest.raises(TableClaimed):
        start("b")
    _run(start("b", reset=True))
    assert _rows(J.read_table(spark, f"{tmp_dir}/out", "day_area_city_ads"), cols) == want


def _files(spark, tmp_dir, parts, schema):
    """One file for each part, in time order."""
    src = f"{tmp_dir}/src"
    os.makedirs(src)
    for i, rows in enumerate(parts):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp_dir}/b{i}")
        f = [x for x in os.listdir(f"{tmp_dir}/b{i}") if x.endswith(".parquet")][0]
        os.rename(f"{tmp_dir}/b{i}/{f}", f"{src}/part-{i}.parquet")
        os.utime(f"{src}/part-{i}.parquet", (time.time() + i, time.time() + i))
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", "1").parquet(src)


CLICK = "ts timestamp, event_id long, area string, city string, user_id string, ads_id string"


@pytest.fixture()
def zone(spark):
    key, before = "spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone")
    yield lambda z: spark.conf.set(key, z)
    spark.conf.set(key, before)


def test_day_watermark_keeps_one_state_row_outside_utc(spark, tmp_dir, zone):
    zone("Asia/Shanghai")
    # one local day, on both sides of UTC midnight
    utc = dt.datetime(2024, 1, 4, 20, tzinfo=dt.timezone.utc)
    first = [(utc + dt.timedelta(minutes=i), i, "n", "c", "u", "1") for i in range(5)]
    later = [(utc + dt.timedelta(hours=6, minutes=i), 10 + i, "n", "c", "u", "1") for i in range(3)]
    clicks = _files(spark, tmp_dir, [first, later], CLICK).withColumn("day", F.date_format("ts", "yyyy-MM-dd"))
    _run(J.start_running_counts(clicks, f"{tmp_dir}/out", f"{tmp_dir}/ck", mode="update", day_watermark="2 days",
                                trigger=J.AVAILABLE_NOW))
    assert _rows(J.read_table(spark, f"{tmp_dir}/out", "day_area_city_ads"), ["day", "click_count"]) == [("2024-01-05", 8)]


@pytest.mark.parametrize("name", ["America/Los_Angeles", "Asia/Shanghai", "UTC"])
def test_state_blacklist_keeps_the_counters_of_the_running_day(spark, tmp_dir, zone, name):
    zone(name)
    utc = dt.datetime(2024, 1, 5, 3, tzinfo=dt.timezone.utc)  # the evening of the 4th in Los Angeles
    parts = [[(utc + dt.timedelta(minutes=2 * b + i), 2 * b + i, "n", "c", "u", "1") for i in range(2)] for b in range(3)]
    clicks = _files(spark, tmp_dir, parts, CLICK).withColumn("day", F.date_format("ts", "yyyy-MM-dd"))
    _run(J.start_blacklist(clicks, f"{tmp_dir}/out", f"{tmp_dir}/ck", threshold=4, mode="row", watermark="1 minute",
                           trigger=J.AVAILABLE_NOW))
    assert _rows(J.read_blacklist(spark, f"{tmp_dir}/out"), ["user_id"]) == [("u",)]
    assert _rows(J.read_passed_clicks(spark, f"{tmp_dir}/out"), ["event_id"]) == [(0,), (1,), (2,), (3,)]


@pytest.mark.parametrize("mode", ["batch", "row"])
def test_a_batch_is_read_once_and_leaves_no_scratch(spark, tmp_dir, mode):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(x):
        seen.add(1)
        return x
    clicks = spark.range(60).select(
        F.timestamp_seconds(F.lit(1704100000) + F.col("id")).alias("ts"), F.col("id").alias("event_id"), F.lit("n").alias("area"),
        F.lit("c").alias("city"), counted((F.col("id") % 3).cast("string")).alias("user_id"), F.lit("1").alias("ads_id"),
        F.lit("2024-01-01").alias("day"))
    out, root = f"{tmp_dir}/bl", checkpoint_root(spark).removeprefix("file:")
    for n in ("blacklist_counters", "blacklist_listed", "blacklist_passed", "day_area_city_ads", "area_ads_top3", "area_ads_top3_json", "last_hour"):
        J._table(out, n).claim(spark, f"{tmp_dir}/ck")
    before = sorted(os.listdir(root))
    J.apply_blacklist_batch(clicks, 0, out, threshold=4, mode=mode, counts=True)
    assert seen.value == 60 and sorted(os.listdir(root)) == before


def test_update_mode_with_day_watermark(spark, sliced, tmp_dir):
    q = _run(J.start_running_counts(_stream(spark, sliced), f"{tmp_dir}/out", f"{tmp_dir}/ck", mode="update",
                                    day_watermark="2 days", trigger=J.AVAILABLE_NOW))
    # events arrive in time order, so nothing is late and the totals are exact
    assert all(p["stateOperators"][0].get("numRowsDroppedByWatermark", 0) == 0
               for p in q.recentProgress if p.get("stateOperators"))
    r3 = _batch(spark).transform(A.day_area_city_ads)
    cols = ["day", "area", "city", "ads_id", "click_count"]
    assert _rows(J.read_table(spark, f"{tmp_dir}/out", "day_area_city_ads"), cols) == _rows(r3, cols)


def test_blacklist_batch_step_replay_is_idempotent(spark, tmp_dir):
    schema = "ts timestamp, event_id long, area string, city string, user_id string, ads_id string, day string"
    t0 = dt.datetime(2024, 1, 1, 10)
    rows = [(t0 + dt.timedelta(minutes=i), i, "n", "c", "u1", "1", "2024-01-01") for i in range(6)]
    b0 = spark.createDataFrame(rows[:3], schema)
    b1 = spark.createDataFrame(rows[3:], schema)
    out = f"{tmp_dir}/bl"
    for n in ("blacklist_counters", "blacklist_listed", "blacklist_passed"):
        J._table(out, n).claim(spark, f"{tmp_dir}/ck")
    J.apply_blacklist_batch(b0, 0, out, threshold=4)
    J.apply_blacklist_batch(b1, 1, out, threshold=4)
    first = [_rows(df, cols) for df, cols in zip(J.read_blacklist_tables(spark, out),
                                                 (["user_id"], ["event_id"]))]
    J.apply_blacklist_batch(b1, 1, out, threshold=4)  # replayed batch
    again = J.read_blacklist_tables(spark, out)
    assert first[0] == _rows(again[0], ["user_id"]) == [("u1",)]
    assert first[1] == _rows(again[1], ["event_id"])
    # snapshot semantics: u1 was not listed when batch 1 began, so all 6 clicks passed
    assert _rows(again[1], ["event_id"]) == [(i,) for i in range(6)]
    counters = J.read_table(spark, out, "blacklist_counters")
    assert _rows(counters, ["user_id", "n"]) == [("u1", 6)]


def test_last_hour_ignores_clicks_behind_the_window(spark, tmp_dir):
    schema = "ts timestamp, event_id long, area string, city string, user_id string, ads_id string, day string"
    t0 = dt.datetime(2024, 1, 1, 12)
    first = [(t0 + dt.timedelta(minutes=m), m, "n", "c", "u", "1", "2024-01-01") for m in range(0, 120, 10)]
    late = [(t0 + dt.timedelta(minutes=5), 500, "n", "c", "u", "1", "2024-01-01"),     # behind the watermark
            (t0 + dt.timedelta(minutes=115), 501, "n", "c", "u", "1", "2024-01-01")]   # on time
    folder = f"{tmp_dir}/clicks"
    for i, part in enumerate([first, late]):
        spark.createDataFrame(part, schema).coalesce(1).write.parquet(f"{folder}/b{i}")
        time.sleep(1.1)
    files = sorted(p for p in os.listdir(folder))
    src = f"{tmp_dir}/src"
    os.makedirs(src)
    for i, sub in enumerate(files):
        f = [x for x in os.listdir(f"{folder}/{sub}") if x.endswith(".parquet")][0]
        os.rename(f"{folder}/{sub}/{f}", f"{src}/part-{i}.parquet")
        os.utime(f"{src}/part-{i}.parquet", (time.time() + i, time.time() + i))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", "1").parquet(src)
    q = _run(J.start_last_hour(stream, f"{tmp_dir}/out", f"{tmp_dir}/ck", trigger=J.AVAILABLE_NOW))
    assert len([p for p in q.recentProgress if p["numInputRows"]]) == 2
    # Spark may or may not drop the late click (it only promises to keep
    # data newer than the watermark); the serving view never shows it
    got = {r.minute: r.click_count for r in J.read_last_hour(spark, f"{tmp_dir}/out").collect()}
    assert "12:05" not in got and got["13:55"] == 1 and got["13:50"] == 1


def test_live_trigger_processes_and_stops(spark, sliced, tmp_dir):
    q = J.start_running_counts(_stream(spark, sliced), f"{tmp_dir}/out", f"{tmp_dir}/ck", mode="update",
                               trigger=J.Trigger(processing_time="1 second"), name="live_counts")
    try:
        q.processAllAvailable()
        assert q.isActive and q.name == "live_counts"
    finally:
        q.stop()
    r3 = _batch(spark).transform(A.day_area_city_ads)
    cols = ["day", "area", "city", "ads_id", "click_count"]
    assert _rows(J.read_table(spark, f"{tmp_dir}/out", "day_area_city_ads"), cols) == _rows(r3, cols)


def test_a_table_whose_head_is_lost_is_not_started_anew(spark, tmp_dir):
    t = _claimed(spark, tmp_dir, "lost", ["k"])
    t.upsert(spark.createDataFrame([("a", 5)], "k string, n long"), 0)
    os.rename(f"{tmp_dir}/lost-head", f"{tmp_dir}/elsewhere")
    with pytest.raises(TableClaimed, match="which of its folders"):
        t.claim(spark, f"{tmp_dir}/ck")
    os.rename(f"{tmp_dir}/elsewhere", f"{tmp_dir}/lost-head")
    t.claim(spark, f"{tmp_dir}/ck")
    assert _rows(t.read(spark), ["k", "n"]) == [("a", 5)]
    assert t.compact(spark) and len(t._heads(spark)) == 2  # a new note beside the old one, none written over


def test_readers_see_all_tables_as_of_the_last_recorded_batch(spark, tmp_dir):
    log = CommitLog(f"{tmp_dir}/ck/serving-commits")
    tables = [KeyedTable(f"{tmp_dir}/{n}", ["day", "k"], "day") for n in ("one", "two")]
    for t in tables:
        t.claim(spark, f"{tmp_dir}/ck", commits=log)
    assert log.last(spark) == -1
    rows = lambda n: spark.createDataFrame([("2024-01-01", "a", n)], "day string, k string, n long")
    seen = lambda: [_rows(t.read(spark), ["n"]) if t.read(spark) is not None else None for t in tables]
    for batch in range(3):
        tables[0].upsert(rows(batch), batch)
        assert seen()[0] == ([(batch - 1,)] if batch else [])  # in the middle of a batch
        tables[1].upsert(rows(batch), batch)
        log.record(spark, batch)
        assert seen() == [[(batch,)]] * 2 and log.last(spark) == batch
    tables[0].upsert(rows(9), 3)
    assert tables[0].compact(spark) and seen() == [[(2,)]] * 2  # what is not recorded is not compacted
    assert _rows(tables[0].read(spark, below=4), ["n"]) == [(2,)]


def test_a_recorded_batch_is_not_applied_again(spark, tmp_dir):
    log, done = CommitLog(f"{tmp_dir}/log"), []
    step = J._once(spark, log, lambda batch, batch_id: done.append(batch_id))
    for batch_id in (0, 1, 1, 0, 2):
        step(None, batch_id)
    J._once(spark, log, lambda batch, batch_id: done.append(batch_id))(None, 2)  # restarted before the checkpoint knew
    assert done == [0, 1, 2]

    def fails(batch, batch_id):
        raise RuntimeError
    with pytest.raises(RuntimeError):
        J._once(spark, log, fails)(None, 3)
    assert log.last(spark) == 2


def test_last_hour_reads_two_days(spark, sliced, tmp_dir):
    _run(J.start_last_hour(_stream(spark, sliced), f"{tmp_dir}/out", f"{tmp_dir}/ck", trigger=J.AVAILABLE_NOW))
    plan = J.read_last_hour(spark, f"{tmp_dir}/out")._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\n]*_part[^\n]*>=", plan), re.findall("PartitionFilters.{200}", plan)


def _counts(spark, rows):
    return spark.createDataFrame([("2024-01-01", *r) for r in rows], "day string, area string, ads_id string, click_count long")


def test_top_ads_follow_from_the_top_so_far_and_the_changes(spark):
    before = _counts(spark, [("n", "1", 9), ("n", "2", 7), ("n", "3", 7), ("s", "1", 4)]).withColumn("rank", F.lit(0))
    cols = ["area", "ads_id", "click_count", "rank"]
    # a tie with the third goes by id, a clicked ad of the top keeps one row, the area without clicks is left out
    got = A.area_ads_top3_update(before, _counts(spark, [("n", "2", 8), ("n", "25", 7), ("w", "5", 1)]))
    assert _rows(got, cols) == [("n", "1", 9, 1), ("n", "2", 8, 2), ("n", "25", 7, 3), ("w", "5", 1, 1)]
    assert _rows(A.area_ads_top3_update(None, _counts(spark, [("n", str(i), i) for i in range(6)])), cols) == \
        [("n", "3", 3, 3), ("n", "4", 4, 2), ("n", "5", 5, 1)]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_top_ads_by_changes_equal_the_report_over_all_batches(spark, seed):
    rnd = __import__("random").Random(seed)
    clicks, top = [], None
    for _ in range(4):
        batch = [("2024-01-01", rnd.choice("ns"), rnd.choice("xyz"), str(rnd.randrange(9))) for _ in range(rnd.randrange(1, 25))]
        clicks += batch
        per_city = A.day_area_city_ads(spark.createDataFrame(clicks, "day string, area string, city string, ads_id string"))
        hit = spark.createDataFrame(batch, "day string, area string, city string, ads_id string").select("day", "area", "ads_id").distinct()
        changed = A.ads_totals(per_city).join(hit, ["day", "area", "ads_id"], "left_semi")
        new = A.area_ads_top3_update(top, changed)
        kept = [] if top is None else top.join(hit.select("day", "area").distinct(), ["day", "area"], "left_anti").collect()
        top = spark.createDataFrame(new.collect() + kept, new.schema)
        cols = ["day", "area", "ads_id", "click_count", "rank"]
        assert _rows(top, cols) == _rows(A.area_ads_top3(per_city), cols)


def test_running_counts_read_no_totals_back(spark, sliced, tmp_dir, monkeypatch):
    seen = []
    read = KeyedTable.read
    monkeypatch.setattr(KeyedTable, "read", lambda self, *a, **k: seen.append(os.path.basename(self.path)) or read(self, *a, **k))
    _run(J.start_running_counts(_stream(spark, sliced), f"{tmp_dir}/out", f"{tmp_dir}/ck", trigger=J.AVAILABLE_NOW))
    assert set(seen) == {"area_ads_top3"}


def test_a_pinned_table_looks_nothing_up_again(spark, tmp_dir, monkeypatch):
    t = _claimed(spark, tmp_dir, "pin", ["day", "k"], "day")
    t.unique = True
    t.pinned(spark)
    schema = "day string, k string, n long"
    t.upsert(spark.createDataFrame([("2024-01-01", "a", 1), ("2024-01-01", None, 2)], schema), 0)
    assert _rows(t.read(spark, below=1).na.fill("-"), ["k", "n"]) == [("-", 2), ("a", 1)]
    monkeypatch.setattr(KeyedTable, "_heads", lambda *a: pytest.fail("looked up"))
    t.upsert(spark.createDataFrame([("2024-01-01", "a", 5), ("2024-01-01", "b", 1)], schema), 1)
    assert _rows(t.read(spark, below=2, only=["2024-01-01"]).na.fill("-"), ["k", "n"]) == [("-", 2), ("a", 5), ("b", 1)]
    assert _rows(t.read(spark, below=1).na.fill("-"), ["k", "n"]) == [("-", 2), ("a", 1)]


def test_an_error_in_one_of_the_writes_fails_the_batch(spark):
    done = []

    def fails():
        raise RuntimeError("lost")
    with pytest.raises(RuntimeError, match="lost"):
        J._all_at_once(spark, fails, lambda: done.append(spark.range(3).count()))
    assert done == [3]
