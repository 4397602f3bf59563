"""Driver contract: entry/queries/oracle_sql shapes and bench.py's one JSON line."""

from __future__ import annotations

import json
import os
import subprocess
import sys

import __spark_entry__ as entry

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_contract_shapes():
    qs, sql = entry.queries(), entry.oracle_sql()
    assert len(qs) >= 60 and set(sql) <= set(qs)
    assert all(callable(f) for f in qs.values())
    assert all(isinstance(s, str) and s.strip() for s in sql.values())


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_ONLY="^bucket_summary$", BENCH_CPUS="2")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], capture_output=True, text=True,
                         env=env, timeout=600, check=True).stdout.strip().splitlines()
    rec = json.loads(out[-1])
    assert rec["unit"] == "sec" and rec["metric"] == "total_query_sec"
    assert set(rec["queries"]) == {"bucket_summary"} and rec["value"] > 0 and rec["sf"] == 0.001
