"""bench.py prints exactly one JSON line with the agreed fields."""

from __future__ import annotations

import json
import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_REPS="1",
               BENCH_DUCKDB="0", BENCH_CPUS="2", CASEKIT_DRIVER_MEMORY="2g")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], env=env, cwd=ROOT,
                         capture_output=True, text=True, timeout=900)
    assert out.returncode == 0, out.stderr[-2000:]
    lines = [l for l in out.stdout.splitlines() if l.strip()]
    assert len(lines) == 1
    d = json.loads(lines[0])
    assert d["metric"] and d["unit"] == "sec" and d["sf"] == 0.001
    assert d["value"] > 0 and set(d["queries"]) >= {"ops_kpis", "case_lifecycle"}
