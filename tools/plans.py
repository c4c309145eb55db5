"""Write PLANS.md: the key physical operators of every batch query.

Usage: python tools/plans.py [sf_dir]   (default /root/testdata/sf0.1)

For each registered batch query the final adaptive plan is taken after one
run, and the operators that matter at scale are listed: exchanges (what
shuffles, on which keys), join strategies, partial/final WindowGroupLimit,
reused exchanges, and for each Parquet scan its pushed filters and read
schema.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from clickscope.plans.checks import QUERIES  # noqa: E402
from clickscope.plans.streams import STREAM_QUERIES  # noqa: E402
from clickscope.plans.tables import TABLE_QUERIES  # noqa: E402
from clickscope.session import local_session  # noqa: E402

KEEP = re.compile(r"^(\s*[:+\- ]*)(\*\(\d+\) )?(Exchange|BroadcastExchange|ReusedExchange|BroadcastHashJoin|SortMergeJoin|"
                  r"ShuffledHashJoin|WindowGroupLimit|Window|HashAggregate|ObjectHashAggregate|SortAggregate|"
                  r"TakeOrderedAndProject|Generate|Union)\b")


def summary(plan: str) -> list[str]:
    out = []
    for line in plan.splitlines():
        m = KEEP.match(line)
        if m:
            out.append(line.rstrip()[:150])
        elif "PushedFilters" in line or "ReadSchema" in line or line.strip().startswith("FileScan"):
            out.append("      " + line.strip()[:150])
    return out


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    lines = ["# PLANS", "", f"Final adaptive physical plans at `{sf_dir}` (local[8], 8 shuffle partitions),",
             "reduced to the operators that decide cost at scale. Generated by `tools/plans.py`.", ""]
    for name, q in QUERIES.items():
        if name in STREAM_QUERIES or name in TABLE_QUERIES:
            continue
        df = q(spark, sf_dir)
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
        plan = plan.split("== Initial Plan ==")[0]
        lines += [f"## {name}", "", "```", *summary(plan), "```", ""]
    spark.stop()
    with open("PLANS.md", "w") as f:
        f.write("\n".join(lines))


if __name__ == "__main__":
    main()
