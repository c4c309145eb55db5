"""Bench: time the headline reports at one scale factor.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
One warm-up pass (JVM, code caches), then ``BENCH_PASSES`` (default 3)
timed passes; each query is timed from building its DataFrame to the
collected result, and the best pass per query is reported (the host is a
shared VM whose timings vary by tens of percent between identical runs).
Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from clickscope.plans import HEADLINE, QUERIES  # noqa: E402
from clickscope.session import local_session  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = local_session(cpus, shuffle_partitions=cpus, app="clickscope-bench")
    spark.sparkContext.setLogLevel("ERROR")
    for name in HEADLINE:
        QUERIES[name](spark, sf_dir).collect()
    passes = int(os.environ.get("BENCH_PASSES", "3"))
    times: dict[str, float] = {}
    rows: dict[str, int] = {}
    for _ in range(passes):
        for name in HEADLINE:
            t0 = time.perf_counter()
            out = QUERIES[name](spark, sf_dir).collect()
            secs = round(time.perf_counter() - t0, 3)
            times[name] = min(secs, times.get(name, secs))
            rows[name] = len(out)
    spark.stop()
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "total_sec_headline_reports",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "rows": rows,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
        "passes": passes,
    }))


if __name__ == "__main__":
    main()
