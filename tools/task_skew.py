"""Hot-key demonstration from Spark's event log (no UI).

Takes lineitem of one scale folder, gives one order key a third of the
rows (keys of the first third of the rows are replaced by one existing
order key), and numbers items per key three ways: a row_number window, the
skew-safe ``sequence_within``, and the aggregate form of latest-row-per-key;
then joins the items to orders on that key (sort-merge, where adaptive
execution splits the hot partition). For each
run it reports, per stage after a shuffle, the largest share of the
stage's shuffled records read by one task - the part of the work that one
task cannot share. (Scan stages are left out: the supplied file is a single
row group, read by one task whatever the plan.)

    python tools/task_skew.py [sf_dir]
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from pyspark.sql import Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from martlet.operators.dedup import first_per_key  # noqa: E402
from martlet.operators.sequence import sequence_within  # noqa: E402
from martlet.session import build_session  # noqa: E402


def stage_shares(log_dir: str, job_group: str) -> list[tuple[int, int, float]]:
    """(stage id, tasks, max share of shuffled records read by one task)
    for shuffle-reading stages of jobs tagged with ``job_group``."""
    stages, jobs_of_group, stage_job = {}, set(), {}
    paths = [p for p in glob.glob(f"{log_dir}/**/*", recursive=True) if os.path.isfile(p)]
    for path in paths:
        if path.endswith(".zstd") or path.endswith(".lz4"):
            continue
        for line in open(path):
            e = json.loads(line)
            ev = e.get("Event")
            if ev == "SparkListenerJobStart":
                props = e.get("Properties", {})
                if props.get("spark.jobGroup.id") == job_group:
                    jobs_of_group.add(e["Job ID"])
                    for s in e.get("Stage IDs", []):
                        stage_job[s] = e["Job ID"]
            elif ev == "SparkListenerTaskEnd":
                m = e.get("Task Metrics") or {}
                recs = m.get("Shuffle Read Metrics", {}).get("Total Records Read", 0)
                stages.setdefault(e["Stage ID"], []).append(recs)
    out = []
    for sid, recs in sorted(stages.items()):
        if stage_job.get(sid) in jobs_of_group and sum(recs) > 0:
            out.append((sid, len(recs), max(recs) / sum(recs)))
    return out


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    log_dir = tempfile.mkdtemp(prefix="run-eventlog-")
    spark = build_session("local[*]", shuffle_partitions=16, extra={
        "spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir, "spark.eventLog.compress": "false",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        # the default skew thresholds (256 MB) are far above this data size
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256k",
        "spark.sql.autoBroadcastJoinThreshold": "-1"})
    li = spark.read.parquet(f"{sf}/lineitem.parquet")
    cut = li.approxQuantile("l_orderkey", [1 / 3], 0.001)[0]
    first = li.agg(F.min("l_orderkey")).first()[0]
    hot = li.withColumn("k", F.when(F.col("l_orderkey") <= cut, F.lit(first)).otherwise(F.col("l_orderkey")))
    orders = spark.read.parquet(f"{sf}/orders.parquet").select(F.col("o_orderkey").alias("k"), "o_orderdate")
    order = ["l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice"]
    runs = {
        "row_number window": lambda: hot.withColumn(
            "rn", F.row_number().over(Window.partitionBy("k").orderBy(*order))),
        "sequence_within": lambda: sequence_within(hot, ["k"], order, "rn"),
        "first_per_key (aggregate)": lambda: first_per_key(
            hot, ["k"], [("l_shipdate", False), ("l_partkey", True)], ["l_extendedprice"]),
        # AQE splits a skewed partition along map outputs; the supplied file is
        # one row group (one mapper), so spread it over mappers first, as a
        # large multi-file input is
        "join on the hot key (AQE)": lambda: hot.repartition(16).join(orders, "k"),
    }
    sc = spark.sparkContext
    for name, build in runs.items():
        sc.setJobGroup(name, name)
        build().write.format("noop").mode("overwrite").save()
    sc.setJobGroup("done", "done")
    spark.stop()
    print(f"hot key share of rows: 1/3 of {sf}/lineitem; shuffle partitions 16")
    for name in runs:
        shares = stage_shares(log_dir, name)
        worst = max((s for _, n, s in shares if n > 1), default=0.0)
        print(f"{name:28s} max share of a stage's records in one task: {worst:.2f}  "
              f"stages={[(sid, n, round(s, 2)) for sid, n, s in shares]}")


if __name__ == "__main__":
    main()
