import os
import time


from clickscope.operators import ads as A
from clickscope.operators.area import area_top_products
from clickscope.sinks.tables import overwrite_table
from clickscope.sources import bindings as B
from clickscope.sources.ads_log import parse_ads_log, text_ads_stream
from clickscope.sources.tables import load_tables
from clickscope.streaming import ads_jobs as J
from tests.conftest import SF_SMALL


def test_load_tables_from_folder(spark, tmp_dir):
    t = B.test_tables(spark, SF_SMALL)
    model = B.action_model(t)
    overwrite_table(model.actions.drop("event_id", "ts"), f"{tmp_dir}/user_visit_action")
    overwrite_table(model.users, f"{tmp_dir}/user_info")
    overwrite_table(model.cities, f"{tmp_dir}/city_info")
    overwrite_table(model.products, f"{tmp_dir}/product_info")
    loaded = load_tables(spark, path=tmp_dir)
    assert loaded.actions.columns[:3] == ["date", "user_id", "session_id"]
    cols = ["area", "product_name", "click_count", "city_remark", "rank"]
    a = area_top_products(loaded.actions, loaded.cities, loaded.products, other_label="other")
    b = area_top_products(model.actions, model.cities, model.products, other_label="other")
    assert sorted(a.select(cols).collect()) == sorted(b.select(cols).collect())


def test_csv_text_stream_equals_batch(spark, tmp_dir):
    """ads_log CSV lines in two files -> text stream -> parse -> R3/R4."""
    t = B.test_tables(spark, SF_SMALL)
    clicks = B.ads_clicks(t)
    lines = clicks.orderBy("event_id").selectExpr(
        "concat_ws(',', CAST(unix_millis(ts) AS STRING), area, city, user_id, ads_id) AS value")
    rows = [r.value for r in lines.collect()] + ["abc,x"]
    folder = os.path.join(tmp_dir, "lines")
    os.makedirs(folder)
    half = len(rows) // 2
    for i, chunk in enumerate([rows[:half], rows[half:]]):
        path = os.path.join(folder, f"part-{i}.txt")
        with open(path, "w") as f:
            f.write("\n".join(chunk) + "\n")
        os.utime(path, (time.time() + i, time.time() + i))
    parsed, rejects = parse_ads_log(text_ads_stream(spark, folder, max_files_per_trigger=1))
    q = J.start_running_counts(parsed, f"{tmp_dir}/out", f"{tmp_dir}/ck", trigger=J.AVAILABLE_NOW)
    q.awaitTermination()
    assert q.exception() is None
    cols = ["day", "area", "city", "ads_id", "click_count"]
    got = J.read_table(spark, f"{tmp_dir}/out", "day_area_city_ads").select(cols).collect()
    assert sorted(got) == sorted(A.day_area_city_ads(clicks).select(cols).collect())
    batch_lines = spark.read.text(folder)
    assert [r.value for r in parse_ads_log(batch_lines)[1].collect()] == ["abc,x"]


def test_date_partitioned_log_prunes_partitions(spark, tmp_dir):
    from clickscope.config import CHECK
    from clickscope.operators.actions import filter_actions
    t = B.test_tables(spark, SF_SMALL)
    model = B.action_model(t)
    model.actions.drop("event_id", "ts").write.partitionBy("date").parquet(f"{tmp_dir}/user_visit_action")
    overwrite_table(model.users, f"{tmp_dir}/user_info")
    overwrite_table(model.cities, f"{tmp_dir}/city_info")
    overwrite_table(model.products, f"{tmp_dir}/product_info")
    loaded = load_tables(spark, path=tmp_dir)
    got = filter_actions(loaded.actions, loaded.users, CHECK.condition)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan and "2024-01-05" in plan
    want = filter_actions(model.actions, model.users, CHECK.condition).drop("event_id", "ts")
    cols = sorted(want.columns)
    assert sorted(got.select(cols).collect()) == sorted(want.select(cols).collect())
    days = {r.date for r in got.select("date").distinct().collect()}
    assert min(days) >= "2024-01-05" and max(days) <= "2024-01-25"
