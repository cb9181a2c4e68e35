"""Layers, materialised tables and views (raw / staging / marts).

A layer is a folder under one root on shared storage; optionally it is also
a catalog schema whose location is that folder. Materialising is a full
replace of a Parquet folder (``CREATE OR REPLACE TABLE ... AS``), followed
by a fresh read so later plans scan the files rather than recompute.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_dir

LAYERS = ("raw", "staging", "marts")


def layer_paths(root: str) -> dict[str, str]:
    r = root.rstrip("/")
    return {layer: f"{r}/{layer}" for layer in LAYERS}


def create_schemas(spark: SparkSession, root: str | None = None) -> dict[str, str]:
    """``CREATE SCHEMA IF NOT EXISTS`` for each layer, located under ``root``
    (default: a folder under the shared checkpoint folder)."""
    root = root or f"{shared_dir(spark)}/lake"
    paths = layer_paths(root)
    for layer, path in paths.items():
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {layer} LOCATION '{path}'")
    return paths


def save_table(df: DataFrame, path: str, sort_within: list[str] | None = None) -> DataFrame:
    """Write ``df`` as Parquet at ``path`` (full replace) and return a
    DataFrame reading it. ``sort_within`` orders rows inside each file so
    min/max statistics let filtered scans skip row groups."""
    w = df.sortWithinPartitions(*sort_within) if sort_within else df
    w.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def save_partitioned(df: DataFrame, path: str, by: str, sort_within: list[str] | None = None) -> DataFrame:
    """Write ``df`` as Parquet partitioned by the values of ``by`` (one
    folder per value; full replace) so filters on ``by`` prune folders.
    Rows are range-partitioned on (``by``, ``sort_within``) first: each
    task writes a few neighbouring values, and a value holding many rows is
    spread over several tasks instead of one."""
    cols = [by] + list(sort_within or [])
    (df.repartitionByRange(*cols).sortWithinPartitions(*cols)
     .write.mode("overwrite").partitionBy(by).parquet(path))
    return df.sparkSession.read.parquet(path)


#: A bucket of a bucketed table holds about so many bytes of its largest table.
BUCKET_BYTES = 128 << 20
MAX_BUCKETS = 1 << 15

#: Which part of a heavy key's rows a row belongs to; 0 for all other keys.
SLICE = "_slice"


def bucket_count(input_bytes: int, bucket_bytes: int = BUCKET_BYTES) -> int:
    """Buckets for a table of measured size."""
    return max(1, min(MAX_BUCKETS, -(-input_bytes // bucket_bytes)))


def input_bytes(df: DataFrame) -> int:
    """Bytes of the files that a frame reads, on whatever storage they are."""
    spark = df.sparkSession
    total = 0
    for f in df.inputFiles():
        p = spark._jvm.org.apache.hadoop.fs.Path(f)
        total += p.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(p).getLen()
    return total


def heavy_keys(df: DataFrame, key: str, buckets: int) -> dict:
    """Keys with more rows than half a bucket's share -> into how many slices
    they are parted, so that a slice is at most an eighth of a share (small
    enough to even out over the buckets). Counts are reduced on the map side;
    at most 2 * buckets keys can be that heavy, so the result is bounded by
    the bucket count, not by the data."""
    counts = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    share = df.agg(F.greatest(F.lit(1.0), F.count(F.lit(1)) / F.lit(float(buckets)))).scalar()
    found = counts.withColumn("share", share).where(F.col("n") * 2 > F.greatest("share", F.lit(2.0)))
    return {r[0]: r.k for r in found.select(key, F.ceil(F.col("n") * 8 / F.col("share")).cast("int").alias("k")).limit(2 * buckets).collect()}


def _slices(key: str, heavy: dict, spark: SparkSession, kind) -> DataFrame:
    return F.broadcast(spark.createDataFrame(list(heavy.items()), f"{key} {kind.simpleString()}, _k int"))


def sliced(df: DataFrame, key: str, heavy: dict, within: str) -> DataFrame:
    """``df`` with its rows' slice: those of a heavy key are parted by a hash of ``within``."""
    k = _slices(key, heavy, df.sparkSession, df.schema[key].dataType)
    return df.join(k, key, "left").withColumn(SLICE, F.coalesce(F.pmod(F.xxhash64(within), "_k"), F.lit(0)).cast("int")).drop("_k")


def in_every_slice(df: DataFrame, key: str, heavy: dict) -> DataFrame:
    """``df`` with a copy of a heavy key's rows for each of its slices: what sliced rows join to."""
    k = _slices(key, heavy, df.sparkSession, df.schema[key].dataType)
    return (df.join(k, key, "left").withColumn(SLICE, F.explode(F.sequence(F.lit(0), F.coalesce("_k", F.lit(1)) - 1))).drop("_k"))


def save_bucketed(df: DataFrame, table: str, by: str | list[str], buckets: int,
                  sort_within: list[str] | None = None) -> DataFrame:
    """Write ``df`` as a catalog table bucketed on ``by`` (full replace) and
    return it. Two tables bucketed on the same key with the same bucket
    count join on that key without shuffling either side."""
    by = [by] if isinstance(by, str) else by
    # dealt by bucket first, so each task writes its own buckets and not a file for every one
    w = df.repartition(buckets, *by).write.mode("overwrite").format("parquet").bucketBy(buckets, *by)
    if sort_within:
        w = w.sortBy(*sort_within)
    w.saveAsTable(table)
    return df.sparkSession.table(table)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder name under the shared checkpoint folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def table(spark: SparkSession, path: str) -> DataFrame:
    """Scan a materialised table."""
    return spark.read.parquet(path)


def register_views(frames: dict[str, DataFrame], prefix: str = "") -> list[str]:
    """Expose lazy DataFrames as temporary views (``CREATE OR REPLACE
    VIEW``) so they can be queried by name with ``spark.sql``."""
    names = []
    for name, df in frames.items():
        view = f"{prefix}{name}"
        df.createOrReplaceTempView(view)
        names.append(view)
    return names
