"""Skew-safe operators agree with the window / built-in forms."""

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from martlet.operators.dedup import first_per_key
from martlet.operators.sequence import percentile_within, sequence_in_groups, sequence_within


def _data(spark, n=3000, hot_share=0.4, seed=7):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        k = 0 if rnd.random() < hot_share else rnd.randint(1, 60)
        v = rnd.choice([None] + [round(rnd.uniform(-50, 50), 3) for _ in range(5)]) if i % 17 == 0 \
            else round(rnd.uniform(-50, 50), 3)
        rows.append((k, v, i))
    return spark.createDataFrame(rows, "k int, v double, id int")


def test_sequence_within_matches_row_number(spark):
    df = _data(spark)
    ours = sequence_within(df, ["k"], ["v", "id"], out="rn")
    w = Window.partitionBy("k").orderBy("v", "id")
    ref = df.withColumn("rn_ref", F.row_number().over(w))
    j = ours.join(ref, "id")
    assert j.count() == df.count()
    assert j.where(F.col("rn") != F.col("rn_ref")).count() == 0


def test_percentile_within_matches_percentile(spark):
    df = _data(spark)
    for p in (0.0, 0.5, 0.9, 1.0):
        ours = {r.k: r.pv for r in percentile_within(df, ["k"], "v", p, "pv").collect()}
        ref = {r.k: r.pv for r in df.groupBy("k").agg(F.percentile("v", p).alias("pv")).collect()}
        assert ours.keys() == ref.keys()
        for k in ref:
            assert abs(ours[k] - ref[k]) < 1e-9, (p, k, ours[k], ref[k])


def test_first_per_key_matches_row_number(spark):
    df = _data(spark).withColumn("ts", F.timestamp_seconds(F.col("id") % 50))
    ours = first_per_key(df, ["k"], [("ts", False), ("v", True)], ["id"])
    w = Window.partitionBy("k").orderBy(F.desc("ts"), F.asc("v"), F.asc("id"))
    ref = df.withColumn("rn", F.row_number().over(w)).where("rn = 1").select("k", "id")
    # ties on (ts, v) may pick different ids; compare the ordering values
    a = ours.join(df.select("id", "ts", "v"), "id").select("k", "ts", "v")
    b = ref.join(df.select("id", "ts", "v"), "id").select("k", "ts", "v")
    assert sorted(map(tuple, a.collect()), key=str) == sorted(map(tuple, b.collect()), key=str)


def test_percentiles_within_several_at_once(spark):
    from martlet.operators.sequence import percentiles_within
    df = _data(spark)
    ours = {r.k: (r.a, r.b) for r in percentiles_within(df, ["k"], "v", {"a": 0.25, "b": 0.9}).collect()}
    ref = {r.k: (r.a, r.b) for r in df.groupBy("k").agg(F.percentile("v", 0.25).alias("a"),
                                                         F.percentile("v", 0.9).alias("b")).collect()}
    assert ours.keys() == ref.keys()
    assert all(abs(ours[k][i] - ref[k][i]) < 1e-9 for k in ref for i in (0, 1))


def test_tune_for_input(spark):
    from martlet.session import tune_for_input
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        assert tune_for_input(spark, 100 * (1 << 40)) == 409_600   # 100 TB / 256 MB
        assert tune_for_input(spark, 10 * (1 << 30)) == 40          # 10 GB / 256 MB
        assert tune_for_input(spark, 1000) == 8
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_sequence_within_null_keys_and_values(spark):
    rows = [(None, 3.0, 1), (None, None, 2), (None, 1.0, 3), ("a", None, 4), ("a", 2.0, 5), ("a", 2.0, 6),
            ("b", 1.0, 7)]
    df = spark.createDataFrame(rows, "k string, v double, id int")
    ours = {r.id: r.rn for r in sequence_within(df, ["k"], ["v", "id"], out="rn", num_partitions=3).collect()}
    w = Window.partitionBy("k").orderBy("v", "id")
    ref = {r.id: r.rn for r in df.withColumn("rn", F.row_number().over(w)).collect()}
    assert ours == ref


def test_sequence_in_groups_with_hot_and_null_keys(spark):
    rows = [(None if i % 7 == 0 else i % 5, (i * 37) % 11, i) for i in range(600)]
    df = spark.createDataFrame(rows, "k int, v int, id int")
    want = {r.id: r.rn for r in sequence_within(df, ["k"], ["v", "id"]).collect()}
    for window_rows in (1 << 17, 100, 10):  # no key hot, some, all
        got = sequence_in_groups(df, ["k"], ["v", "id"], window_rows=window_rows).collect()
        assert {r.id: r.rn for r in got} == want and len(got) == len(rows)
    assert sequence_in_groups(df.limit(0), ["k"], ["v", "id"]).count() == 0


def test_items_are_numbered_in_one_shuffle(spark):
    from __spark_entry__ import FLAGSHIP_DIR
    from martlet.sources.fixtures import FixtureSources

    items = FixtureSources(spark, FLAGSHIP_DIR).order_items()
    plan = items._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "Window" in plan


def test_bound_tasks(spark):
    from martlet.session import TASK_BYTES, bound_tasks

    size, count = "spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    before = {c: spark.conf.get(c, None) for c in (size, count)}
    try:
        spark.conf.unset(count)
        spark.conf.set(size, "1g")
        bound_tasks(spark, 1000)
        assert spark.conf.get(size) == str(TASK_BYTES) and spark.conf.get(count, None) is None
        bound_tasks(spark, 6 << 30)
        assert spark.conf.get(count) == "1536"
        spark.conf.set(size, "8m")
        bound_tasks(spark, 1000)
        assert spark.conf.get(size) == "8m" and spark.conf.get(count) == "1536"
    finally:
        for c, v in before.items():
            spark.conf.set(c, v) if v is not None else spark.conf.unset(c)


def test_bound_tasks_bounds_scans(spark):
    from martlet.session import TASK_BYTES, bound_tasks

    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.adaptive.coalescePartitions.initialPartitionNum")
    before = {c: spark.conf.get(c, None) for c in names}
    try:
        spark.conf.set(names[0], "128MB")
        bound_tasks(spark, 1000)
        assert spark.conf.get(names[0]) == str(TASK_BYTES)
        spark.conf.set(names[0], "1m")
        bound_tasks(spark, 1000)
        assert spark.conf.get(names[0]) == "1m"
    finally:
        for c, v in before.items():
            spark.conf.set(c, v) if v is not None else spark.conf.unset(c)
