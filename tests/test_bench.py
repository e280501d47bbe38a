"""bench.py prints exactly one JSON line with the agreed fields."""

import json
import os
import subprocess
import sys

from conftest import ROOT, SF_SMALL


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR=SF_SMALL, BENCH_REPEAT="1", BENCH_CPUS="2")
    res = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py"), "evm_summary_by_building"],
                         capture_output=True, text=True, env=env, timeout=600, cwd=ROOT)
    lines = [line for line in res.stdout.splitlines() if line.strip()]
    assert res.returncode == 0 and len(lines) == 1, res.stderr[-2000:]
    out = json.loads(lines[0])
    assert out["metric"] == "total_query_seconds" and out["unit"] == "sec" and out["sf"] == 0.001
    assert set(out["queries"]) == {"evm_summary_by_building"} and out["value"] > 0 and "failed" not in out
