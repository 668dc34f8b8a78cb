"""bench.py prints exactly one JSON line with the keys the driver records."""

import json
import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_CPUS="2", BENCH_RUNS="1", BENCH_PACK="0")
    out = subprocess.run(
        [sys.executable, os.path.join(ROOT, "bench.py"), "by_product_or_equipment"],
        env=env, capture_output=True, text=True, timeout=600, check=True,
    ).stdout
    lines = [ln for ln in out.splitlines() if ln.strip()]
    assert len(lines) == 1, out
    rec = json.loads(lines[0])
    assert {"metric", "value", "unit", "queries", "sf"} <= rec.keys()
    assert rec["unit"] == "sec" and rec["sf"] == 0.001
    assert set(rec["queries"]) == {"by_product_or_equipment"} and rec["value"] > 0
