"""The batch application: filter once, run the four reports, write them.

Equivalent of the reference's offline main with all four tasks enabled.
The filtered action log feeds three reports, so it is persisted
(MEMORY_AND_DISK; a lost executor's blocks are recomputed from lineage).
The area report reads the unfiltered log, as in the reference.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame

from clickscope.config import Condition, OTHER_LABEL
from clickscope.operators.actions import filter_actions
from clickscope.operators.area import area_top_products
from clickscope.operators.category import (category_action_counts, category_session_counts,
                                           category_session_top10, category_top10)
from clickscope.operators.pageflow import page_conversion
from clickscope.sinks.tables import JdbcTarget, append_table, jdbc_overwrite, overwrite_table
from clickscope.sources.tables import ActionModel


# What the three reports over the filtered log read.
REPORT_COLUMNS = ("event_id", "session_id", "page_id", "action_time", "click_category_id", "order_category_ids",
                  "pay_category_ids")


@dataclass(frozen=True)
class ReportTargets:
    category_top10: JdbcTarget | str
    category_session_top10: JdbcTarget | str
    page_conversion: JdbcTarget | str
    area_product_top3: JdbcTarget | str


def build_reports(model: ActionModel, condition: Condition, task_id: str | None = None,
                  other_label: str = OTHER_LABEL) -> tuple[dict[str, DataFrame], DataFrame]:
    """The four result DataFrames (lazy) and the persisted filtered log."""
    task_id = task_id or str(uuid.uuid4())
    acts = filter_actions(model.actions, model.users, condition, cities=model.cities)
    used = [c for c in REPORT_COLUMNS if c in acts.columns]
    acts = acts.select(*used).persist(StorageLevel.MEMORY_AND_DISK)
    by_session = category_session_counts(acts)
    top = category_top10(category_action_counts(acts, by_session=by_session), task_id=task_id)
    out = {
        "category_top10": top,
        "category_session_top10": category_session_top10(acts, top.drop("task_id"), task_id=task_id,
                                                         by_session=by_session),
        "page_conversion": page_conversion(acts, condition.target_page_flow, task_id=task_id)
        .select("task_id", "pair", "rate"),
        "area_product_top3": area_top_products(model.actions, model.cities, model.products,
                                               other_label=other_label),
    }
    return out, acts


def run_reports(model: ActionModel, condition: Condition, targets: ReportTargets,
                task_id: str | None = None, other_label: str = OTHER_LABEL) -> str:
    """Compute and write all reports; returns the task id.

    Sink modes follow the reference: category top 10 is appended, sessions
    and page conversion replace their table's rows, the area report
    re-creates its table.
    """
    task_id = task_id or str(uuid.uuid4())
    out, acts = build_reports(model, condition, task_id, other_label)
    try:
        once = "task_id" if isinstance(targets.category_top10, JdbcTarget) else None
        append_table(out["category_top10"], targets.category_top10, once_per=once)
        overwrite_table(out["category_session_top10"], targets.category_session_top10)
        overwrite_table(out["page_conversion"], targets.page_conversion)
        if isinstance(targets.area_product_top3, JdbcTarget):
            jdbc_overwrite(out["area_product_top3"], targets.area_product_top3)
        else:
            overwrite_table(out["area_product_top3"], targets.area_product_top3)
    finally:
        acts.unpersist()
    return task_id
