import json
import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_CPUS="2", BENCH_PASSES="1")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], env=env, capture_output=True,
                         text=True, timeout=600, check=True).stdout.strip().splitlines()
    d = json.loads(out[-1])
    assert d["unit"] == "sec" and d["value"] > 0 and d["sf"] == 0.001
    assert len(d["queries"]) == 10 and all(v > 0 for v in d["queries"].values())
