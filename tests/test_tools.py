"""The bench and the stress tool still run and print what they promise (small sizes)."""

import json
import os
import subprocess
import sys

from conftest import ROOT, SF_SMALL


def _run(args, env=None, timeout=900):
    out = subprocess.run([sys.executable, *args], cwd=ROOT, capture_output=True, text=True,
                         timeout=timeout, env={**os.environ, **(env or {})})
    assert out.returncode == 0, out.stderr[-3000:]
    return out.stdout.strip().splitlines()


def test_bench_prints_one_json_line():
    lines = _run(["bench.py"], env={"BENCH_SF_DIR": SF_SMALL, "BENCH_CPUS": "4",
                                    "BENCH_GEN_ROWS": "5000"})
    assert len(lines) == 1
    res = json.loads(lines[0])
    assert res["unit"] == "sec" and res["value"] > 0 and res["sf"] == 0.001
    assert {"transform_1m_bronze_to_gold", "gold_daily_metrics", "dq_report"} <= set(res["queries"])
    assert abs(res["value"] - sum(res["queries"][k] for k in res["headline_steps"])) < 0.01


def test_stress_tool_reports_stages():
    lines = _run(["tools/stress.py", "100000", "3"])
    head = json.loads(lines[0])
    assert abs(head["rows"] - 100000) < 3  # integer split of the rows over the dates
    assert head["gold_rows"] == 3 and head["missing"] == []
    assert all("max_s" in json.loads(line) for line in lines[1:])
