import os
import time

import pytest

from clickscope.__main__ import main
from clickscope.sinks.tables import overwrite_table
from clickscope.sources import bindings as B
from clickscope.streaming import ads_jobs as J
from tests.conftest import SF_SMALL


def test_offline_command(spark, tmp_dir):
    model = B.action_model(B.test_tables(spark, SF_SMALL))
    overwrite_table(model.actions.drop("event_id", "ts"), f"{tmp_dir}/in/user_visit_action")
    overwrite_table(model.users, f"{tmp_dir}/in/user_info")
    overwrite_table(model.cities, f"{tmp_dir}/in/city_info")
    overwrite_table(model.products, f"{tmp_dir}/in/product_info")
    task = main(["offline", "--path", f"{tmp_dir}/in", "--out", f"{tmp_dir}/out", "--task-id", "cli",
                 "--start-date", "2024-01-05", "--end-date", "2024-01-25", "--start-age", "20",
                 "--end-age", "50", "--flow", "1,2,3,4,5,6,7"], spark=spark)
    assert task == "cli"
    for name in ("category_top10", "category_top10_session_count", "page_conversion_rate",
                 "arer_product_click"):
        assert spark.read.parquet(f"{tmp_dir}/out/{name}").count() > 0


@pytest.mark.parametrize("counts_mode", [None, "update", "complete"])
def test_realtime_command_on_text_files(spark, tmp_dir, counts_mode):
    clicks = B.ads_clicks(B.test_tables(spark, SF_SMALL))
    rows = [r.v for r in clicks.orderBy("event_id").selectExpr(
        "concat_ws(',', CAST(unix_millis(ts) AS STRING), area, city, user_id, ads_id) AS v").collect()]
    os.makedirs(f"{tmp_dir}/lines")
    for i, part in enumerate([rows[: len(rows) // 2], rows[len(rows) // 2:]]):
        path = f"{tmp_dir}/lines/p{i}.txt"
        with open(path, "w") as f:
            f.write("\n".join(part) + "\nno click\n")
        os.utime(path, (time.time() + i, time.time() + i))
    qs = main(["realtime", "--text-path", f"{tmp_dir}/lines", "--out", f"{tmp_dir}/serving",
               "--checkpoint", f"{tmp_dir}/ck", "--threshold", "3", "--blacklist-mode", "row",
               *(["--no-filter", "--counts-mode", counts_mode] if counts_mode else []),
               *(["--day-watermark", "90 days"] if counts_mode == "update" else []),
               "--available-now"], spark=spark)
    assert len(qs) == (4 if counts_mode else 2) and all(q.exception() is None for q in qs)
    assert {r.value for r in spark.read.parquet(f"{tmp_dir}/serving/rejects").collect()} == {"no click"}
    assert J.read_table(spark, f"{tmp_dir}/serving", "area_ads_top3").count() > 0
    assert J.read_last_hour(spark, f"{tmp_dir}/serving").count() > 0
