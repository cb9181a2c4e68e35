"""Row numbers and exact percentiles within groups, safe for hot groups.

``row_number() OVER (PARTITION BY k ORDER BY o)`` sends every row of a key
to one task; a key holding a third of the table would then be sorted by a
single task. Here the rows are instead range-partitioned on ``(k, o)``, so
a hot key is spread over many partitions in sort order, and each row's
number is its position inside its partition plus the number of rows of the
same key in earlier partitions. Those per-partition counts form a table
with one row per (partition, key) - a hot key contributes at most one row
per partition - and the final join is on (partition, key), which splits a
hot key the same way.

The range-partitioned, numbered rows are written once as Parquet to the
shared checkpoint folder and read back, so both uses of them see the same
rows and numbers (range bounds come from sampling and would not be
reproducible on recomputation), and a lost executor re-reads files instead
of recomputing the sort. Partition and row ids travel as columns, so
nothing later depends on the physical layout.

Exact percentiles rank distinct values, not rows: rows are counted per
(key, value) first, before any shuffle of rows, so a value that most rows
share is one row from there on. The distinct values are range-partitioned
in the same way, sums of the counts per (partition, key) give the rows
before each partition, and only the (partition, key) pairs that hold a
target rank are looked into. No step holds all values of a group.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import shared_dir


def _written(df: DataFrame) -> DataFrame:
    """Write ``df`` to a fresh folder under the shared checkpoint folder and
    read it back (cuts the lineage, survives executor loss)."""
    path = f"{shared_dir(df.sparkSession)}/martlet-seq-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _ranged(df: DataFrame, keys: list[str], order: list[str], num_partitions: int | None = None) -> DataFrame:
    """``df`` range-partitioned and sorted on (keys, order), written and read
    back, with its partition (_pid) and place (_mid, ascending within it).
    ``num_partitions`` fixes the range partition count; by default adaptive
    execution sizes it (it only merges adjacent ranges up to the advisory
    size, so a hot key still spans many partitions)."""
    sort_cols = [F.col(c) for c in keys + order]
    ranged = (df.repartitionByRange(num_partitions, *sort_cols) if num_partitions
              else df.repartitionByRange(*sort_cols))
    return _written(ranged.sortWithinPartitions(*sort_cols)
                    .withColumn("_pid", F.spark_partition_id())
                    .withColumn("_mid", F.monotonically_increasing_id()))


def _before(keys: list[str], count: str):
    """Rows of a key in the partitions before, from one row per (partition, key)."""
    w = Window.partitionBy(*keys).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(count).over(w), F.lit(0))


def _with_parts(tagged: DataFrame, parts: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join on (partition, key), NULL keys included. A pair holds at most
    one partition's rows, so a hot key cannot skew the join; whether the small
    side is broadcast is left to its size at run time."""
    p = parts.withColumnsRenamed({c: f"_p_{c}" for c in ["_pid", *keys]})
    cond = reduce(lambda a, b: a & b, [tagged[k].eqNullSafe(p[f"_p_{k}"]) for k in keys],
                  tagged["_pid"] == p["_p__pid"])
    return tagged.join(p, cond).drop("_p__pid", *[f"_p_{k}" for k in keys])


def sequence_within(df: DataFrame, keys: list[str], order: list[str], out: str = "rn",
                    num_partitions: int | None = None) -> DataFrame:
    """``df`` plus ``out`` = 1, 2, ... within each key in ``order`` (ascending,
    NULLs first). Same numbers as row_number() when ``order`` is total."""
    tagged = _ranged(df, keys, order, num_partitions)
    parts = (tagged.groupBy("_pid", *keys)
             .agg(F.min("_mid").alias("_first"), F.count(F.lit(1)).alias("_cnt"))
             .withColumn("_off", _before(keys, "_cnt")).drop("_cnt"))
    return (_with_parts(tagged, parts, keys)
            .withColumn(out, F.col("_mid") - F.col("_first") + F.col("_off") + F.lit(1))
            .drop("_pid", "_mid", "_first", "_off"))


#: A key of at most so many rows is numbered in one task.
WINDOW_ROWS = 1 << 17


def sequence_in_groups(df: DataFrame, keys: list[str], order: list[str], out: str = "rn",
                       window_rows: int = WINDOW_ROWS) -> DataFrame:
    """``sequence_within`` for keys of which few or none are hot: rows are
    shuffled once and neither written nor joined. Rows are counted per key
    first (reduced on the map side); only keys with more than ``window_rows``
    rows, at most one in that many rows, take the path of ``sequence_within``."""
    hot = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > window_rows).drop("_n").collect()
    w = Window.partitionBy(*keys).orderBy(*order)

    def numbered(rows: DataFrame) -> DataFrame:
        return rows.withColumn(out, F.row_number().over(w).cast("long"))

    if not hot:
        return numbered(df)
    h = F.broadcast(df.sparkSession.createDataFrame(hot, df.select(*keys).schema).withColumnsRenamed({k: f"_h_{k}" for k in keys}))
    same = reduce(lambda a, b: a & b, [df[k].eqNullSafe(h[f"_h_{k}"]) for k in keys])
    return numbered(df.join(h, same, "left_anti")).unionByName(sequence_within(df.join(h, same, "left_semi"), keys, order, out))


def percentiles_within(df: DataFrame, keys: list[str], value: str, ps: dict[str, float],
                       num_partitions: int | None = None, count: str | None = None,
                       mean: str | None = None) -> DataFrame:
    """Exact interpolated percentiles of ``value`` per key, one output column
    per entry of ``ps`` (name -> p), plus ``count`` and ``mean`` of the values
    if named, from a single ranking pass. Same definition as the
    ``percentile`` aggregate: position p*(n-1) between the sorted values,
    NULLs ignored. One row per key with at least one value (NULL is a key);
    with ``keys=[]`` one row for the whole input (the range partitioning then
    spreads all distinct values over the partitions)."""
    counted = (df.where(F.col(value).isNotNull()).groupBy(*keys, F.col(value).alias("_v"))
               .agg(F.count(F.lit(1)).alias("_cnt")))
    tagged = _ranged(counted, keys, ["_v"], num_partitions)
    # totals per (partition, key); the windows below see one row for each
    whole = Window.partitionBy(*keys)
    parts = (tagged.groupBy("_pid", *keys)
             .agg(F.sum("_cnt").alias("_in"), F.sum(F.col("_v").cast("double") * F.col("_cnt")).alias("_sum"))
             .withColumns({"_off": _before(keys, "_in"), "_n": F.sum("_in").over(whole),
                           "_mean": F.sum("_sum").over(whole) / F.sum("_in").over(whole)}))
    at = {name: F.lit(p) * (F.col("_n") - 1).cast("double") for name, p in ps.items()}
    ranks = [side(pos) + 1 for pos in at.values() for side in (F.floor, F.ceil)]
    hit = reduce(lambda a, b: a | b, [(r > F.col("_off")) & (r <= F.col("_off") + F.col("_in")) for r in ranks])
    near = _with_parts(tagged, parts.where(hit).drop("_in", "_sum"), keys)
    # rows of the key up to and including each value
    run = Window.partitionBy("_pid", *keys).orderBy("_mid").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    near = near.withColumn("_to", F.col("_off") + F.sum("_cnt").over(run))

    def at_rank(rank):
        return F.max(F.when((rank > F.col("_to") - F.col("_cnt")) & (rank <= F.col("_to")), F.col("_v"))).cast("double")

    outs = []
    for name, pos in at.items():
        lo, hi = at_rank(F.floor(pos) + 1), at_rank(F.ceil(pos) + 1)
        place = F.max(pos)
        # same arithmetic as Spark's exact percentile: (ceil - pos) * lo + (pos - floor) * hi
        outs.append(F.when(F.ceil(place) == place, lo).otherwise(
            (F.ceil(place).cast("double") - place) * lo + (place - F.floor(place).cast("double")) * hi)
            .alias(name))
    if count:
        outs.append(F.coalesce(F.max("_n"), F.lit(0)).alias(count))
    if mean:
        outs.append(F.max("_mean").alias(mean))
    return near.groupBy(*keys).agg(*outs)


def percentile_within(df: DataFrame, keys: list[str], value: str, p: float,
                      out: str = "percentile") -> DataFrame:
    """One exact percentile per key (see ``percentiles_within``)."""
    return percentiles_within(df, keys, value, {out: p})
