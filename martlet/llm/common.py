"""What the operators share: reading tables, cutting lineage, words, components."""

from __future__ import annotations

import gc
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

#: White space of the contracts: space and U+0009 to U+000D (what ``bytes.split()`` takes).
SPACES = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; a temporary one only in local mode without it."""
    where = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not where:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        where = tempfile.mkdtemp(prefix="martlet-llm-")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(where)
    return where


def cut(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: evaluated once, kept in the shared folder, lineage cut."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def release(spark: SparkSession, *frames: DataFrame) -> None:
    """Frees disk: deletes the files of frames from ``cut`` that nothing reads any more, and
    has the driver collect its garbage, without which Spark keeps the files of past shuffles."""
    for df in frames:
        at = df._jdf.queryExecution().analyzed().rdd().getCheckpointFile()
        if at.isDefined():
            path = spark._jvm.org.apache.hadoop.fs.Path(at.get())
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    gc.collect()
    spark._jvm.System.gc()


def words(text: Column) -> Column:
    """Array of the runs without white space; empty for null and empty texts."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACES, -1), "")


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once, also where ``body`` uses it within a lambda."""
    return F.transform(F.array(value), body)[0]


HUBS = 1000  # nodes whose edges are not sent to one task, at most
HUB_EDGES = 5_000
ONE_TASK = 500_000  # edges that one task takes, at most


def _with_low(edges: DataFrame, low: DataFrame, rows: int) -> DataFrame:
    """``edges (u, v)`` with m of ``low (u, m, n)``; n: edges of u. Nodes with
    more edges than rows / HUBS (and than HUB_EDGES) are hubs: there are HUBS
    of them at most, so their minima are broadcast and their edges stay where
    they are. The others meet in a shuffle, none with more edges than that."""
    many = max(HUB_EDGES, rows // HUBS)
    hubs = F.broadcast(low.where(F.col("n") > many).select("u", "m"))
    rest = edges.join(hubs.select("u"), "u", "left_anti").join(low.where(F.col("n") <= many).select("u", "m"), "u")
    return edges.join(hubs, "u").select("u", "v", "m").unionByName(rest.select("u", "v", "m"))


def _united(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``components`` of all ``(u, v)`` that a task gets."""
    ends = [(np.asarray(b.column(0)), np.asarray(b.column(1))) for b in frames]
    if not ends:
        return
    node, at = np.unique(np.concatenate([x for pair in zip(*ends, strict=True) for x in pair]), return_inverse=True)
    u, v = at.reshape(2, -1)
    low = np.arange(len(node))  # a smaller node of the same component, by place
    while (apart := low[u] != low[v]).any():
        u, v = u[apart], v[apart]
        np.minimum.at(low, np.maximum(low[u], low[v]), np.minimum(low[u], low[v]))
        while (low[low] != low).any():
            low = low[low]
    yield pa.RecordBatch.from_pydict({"node": pa.array(node), "component": pa.array(node[low])})


def components(edges: DataFrame) -> DataFrame:
    """Connected components of undirected ``edges (a, b)`` by alternating large and small stars.

    Returns ``(node, component)`` for every node with an edge to another one;
    component is its smallest reachable node. Self-loops and null ends are
    ignored. Each round replaces the edges by stars around smaller nodes, so
    no group of neighbours meets in one task: minima are aggregated before
    the shuffle, and hubs get theirs by broadcast (see ``_with_low``). Both
    halves of a round are cut by checkpoint(): each reads its edges five
    times, so a plan of a whole round would hold them 25 times. ONE_TASK edges
    or fewer are joined up in one task, without rounds.
    """
    e = cut(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
            .where("a is not null and b is not null and a <> b").distinct())
    last, rows = None, e.count()
    if rows <= ONE_TASK and e.schema["u"].dataType == LongType():
        return cut(e.coalesce(1).mapInArrow(_united, "node long, component long"))
    while True:
        both = e.select(F.explode(F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))).alias("s")).select("s.u", "s.v")
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"), F.count(F.lit(1)).alias("n"))
        # at most one row for each edge, so repeats may stay: n counts them
        large = cut(_with_low(both, low, 2 * rows).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")))
        low = large.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n"))
        small = (_with_low(large, low, 2 * rows)
                 .select(F.explode(F.array(F.struct(F.col("u").alias("u"), F.col("m").alias("v")),
                                           F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("s"))
                 .select("s.u", "s.v").where("u <> v").distinct())
        e = cut(small)
        now = e.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if now == last:
            break
        last, rows = now, now["n"]
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        e.select("v", "v").distinct())
