import uuid

from clickscope.config import CHECK
from clickscope.plans.checks import QUERIES
from clickscope.plans.reports import ReportTargets, run_reports
from clickscope.sinks.tables import JdbcTarget
from clickscope.sources import bindings as B
from tests.conftest import SF_SMALL

DRIVER = "org.apache.derby.jdbc.EmbeddedDriver"


def _read(spark, t):
    return spark.read.jdbc(t.url, t.table, properties={"driver": DRIVER})


def test_run_reports_writes_all_four(spark, tmp_dir):
    url = f"jdbc:derby:memory:rep{uuid.uuid4().hex[:8]};create=true"
    targets = ReportTargets(
        category_top10=JdbcTarget(url, "CATEGORY_TOP10", driver=DRIVER),
        category_session_top10=JdbcTarget(url, "CATEGORY_SESSION", driver=DRIVER),
        page_conversion=JdbcTarget(url, "PAGE_CONVERSION", driver=DRIVER),
        area_product_top3=f"{tmp_dir}/area_product_top3")
    model = B.action_model(B.test_tables(spark, SF_SMALL))
    task = run_reports(model, CHECK.condition, targets, task_id="t1", other_label=CHECK.other_label)
    assert task == "t1"
    run_reports(model, CHECK.condition, targets, task_id="t2", other_label=CHECK.other_label)

    top = _read(spark, targets.category_top10).collect()
    want = QUERIES["category_top10"](spark, SF_SMALL).drop("task_id").collect()
    assert len(top) == 2 * len(want)  # appended by both runs
    got = sorted(tuple(r)[1:] for r in top if r[0] == "t2")
    assert got == sorted(tuple(r) for r in want)

    sessions = _read(spark, targets.category_session_top10)
    assert {r.task_id for r in sessions.collect()} == {"t2"}  # replaced
    assert sessions.count() == QUERIES["category_session_top10"](spark, SF_SMALL).count()

    pages = sorted((r[1], r[2]) for r in _read(spark, targets.page_conversion).collect())
    want_pages = sorted((r.pair, r.rate) for r in QUERIES["page_conversion"](spark, SF_SMALL).collect())
    assert pages == want_pages

    area = spark.read.parquet(targets.area_product_top3)
    assert sorted(area.collect()) == sorted(QUERIES["area_product_top3"](spark, SF_SMALL).collect())
