"""bench.py runs end to end and prints the one JSON line the driver reads."""

import json
import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_CPUS="4")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], env=env, capture_output=True,
                         text=True, timeout=900)
    lines = [ln for ln in out.stdout.splitlines() if ln.startswith("{")]
    assert len(lines) == 1, out.stderr[-2000:]
    d = json.loads(lines[0])
    assert d["unit"] == "sec" and d["value"] > 0 and d["sf"] == 0.001
    assert {"load_raw", "build_marts", "m17_extract_buckets"} <= set(d["queries"])
    assert d["checks_passed"] == "14/14"
