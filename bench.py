"""Benchmark: build the marts once, then run every registered query.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
Prints one JSON line: {"metric", "value", "unit", "queries", "sf", ...}.

Timings:
  load_raw    fixture adapter -> raw tables written as Parquet (the raw layer)
  build_marts dimensions and facts written as Parquet (full replace)
  write_extracts  the three dashboard extracts as CSV, their totals observed
  <query>     each registered query over the materialised marts, executed
              to completion with the ``noop`` sink (no collect to the driver)

The marts over the sources with planted flaws are built between the steps
and not timed. Before timing, the same pipeline runs once on the smallest scale folder
(BENCH_WARMUP_DIR, default /root/testdata/sf0.001) so JVM class loading and
code generation are not billed to the first timed step; its duration is
reported separately as ``warmup_sec`` and is not part of ``value``.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from martlet import registry  # noqa: E402
from martlet.plans.checks import validation_report  # noqa: E402
from martlet.session import build_session, shared_dir  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=max(8, cpus * 2),
                          app_name="martlet-bench", driver_memory="8g")
    root = shared_dir(spark)
    warm_dir = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001").rstrip("/")
    warmup = run_all(spark, warm_dir, f"{root}/bench-warm-{os.getpid()}") if warm_dir != sf_dir else {}
    timings = run_all(spark, sf_dir, f"{root}/bench-{os.getpid()}")
    report = validation_report(registry.model(spark, sf_dir), None).collect()

    sf = re.search(r"sf([0-9.]+)", sf_dir)
    total = sum(timings.values())
    print(json.dumps({
        "metric": "total_sec_all_queries",
        "value": round(total, 3),
        "unit": "sec",
        "queries": {k: round(v, 3) for k, v in timings.items()},
        "sf": float(sf.group(1)) if sf else sf_dir,
        "cpus": cpus,
        "n_queries": len(timings) - 3,
        "warmup_sec": round(sum(warmup.values()), 3),
        "checks_passed": f"{sum(bool(r.passed) for r in report)}/{len(report)}",
    }))
    spark.stop()


def run_all(spark, sf_dir: str, run_dir: str) -> dict[str, float]:
    """Raw layer, marts, then every registered query; seconds per step."""
    timings: dict[str, float] = {}
    t0 = time.perf_counter()
    m = registry.model(spark, sf_dir).with_raw_written(run_dir)
    timings["load_raw"] = time.perf_counter() - t0

    t0 = time.perf_counter()
    marts = m.materialize(f"{run_dir}/marts")
    timings["build_marts"] = time.perf_counter() - t0
    registry.set_model(spark, sf_dir, marts)

    t0 = time.perf_counter()
    marts.write_extracts(f"{run_dir}/extracts")
    timings["write_extracts"] = time.perf_counter() - t0

    # what the queries over flawed sources read; a fixture, not a query
    registry.model(spark, sf_dir, registry.FlawedSources)
    for name, fn in registry.queries().items():
        t0 = time.perf_counter()
        fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
        timings[name] = time.perf_counter() - t0

    return timings


if __name__ == "__main__":
    main()
