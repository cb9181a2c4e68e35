"""Results do not depend on the driver machine's time zone."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = """
import sys
sys.path.insert(0, %r)
from martlet.session import build_session
from martlet import registry
spark = build_session("local[*]", app_name="tz")
m = registry.model(spark, "/root/testdata/sf0.001")
print("RESULT", m.fct_order_items.count(), m.fct_orders.count(),
      sorted(tuple(r) for r in m.extract_buckets().collect()))
""" % ROOT


def test_non_utc_driver_zone():
    env = dict(os.environ, TZ="America/Sao_Paulo")
    out = subprocess.run([sys.executable, "-c", SCRIPT], env=env, capture_output=True, text=True, timeout=600)
    line = [ln for ln in out.stdout.splitlines() if ln.startswith("RESULT")]
    assert line, out.stderr[-2000:]
    assert line[0].startswith("RESULT 2882 710 ")
    assert "('31+', 272, 49, 131)" in line[0]
