"""bench.py prints exactly one JSON line with the fields the driver records."""

import json
import os
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]


def test_bench_prints_one_json_line(tmp_dir):
    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_CPUS="2", BENCH_REPEATS="1",
               BENCH_QUERIES="fact_orders,executive_kpis,gold_build,silver_build", TMPDIR=tmp_dir)
    out = subprocess.run([sys.executable, str(ROOT / "bench.py")], env=env, capture_output=True, text=True,
                         timeout=600, check=True)
    lines = [line for line in out.stdout.splitlines() if line.strip()]
    assert len(lines) == 1
    result = json.loads(lines[0])
    assert result["unit"] == "sec" and result["sf"] == 0.001 and "errors" not in result
    assert set(result["queries"]) == {"fact_orders", "executive_kpis", "gold_build", "silver_build"}
    assert result["value"] == round(sum(result["queries"].values()), 3)
