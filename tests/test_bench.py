"""bench.py prints exactly one JSON line with a time per query."""

import json
import os
import subprocess
import sys

from conftest import ROOT, SF_SMALL


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR=SF_SMALL, BENCH_REPEAT="1", BENCH_CPUS="2",
               BENCH_QUERIES="leads_funnel,ab_significance,stg_sales_reps",
               BENCH_DRIVER_MEMORY="2g")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], env=env,
                         capture_output=True, text=True, timeout=600, cwd="/tmp")
    assert out.returncode == 0, out.stderr[-2000:]
    lines = [ln for ln in out.stdout.splitlines() if ln.strip()]
    assert len(lines) == 1
    result = json.loads(lines[0])
    assert result["unit"] == "sec" and result["sf"] == 0.001
    assert set(result["queries"]) == {"leads_funnel", "ab_significance", "stg_sales_reps"}
    assert abs(result["value"] - sum(result["queries"].values())) < 0.01
    assert "errors" not in result
