import json
import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_CPUS="2",
               BENCH_QUERIES="read_filter_project,cast_orders")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], env=env, capture_output=True,
                         text=True, timeout=600)
    lines = [line for line in out.stdout.splitlines() if line.strip()]
    assert len(lines) == 1, out.stdout + out.stderr
    d = json.loads(lines[0])
    assert d["unit"] == "sec" and set(d["queries"]) == {"read_filter_project", "cast_orders"}
    assert d["value"] > 0 and d["sf"] == 0.001 and "errors" not in d
