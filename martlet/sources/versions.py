"""Tables that are replaced version by version, never in place.

    <table>/_data/<number>-<id>/part-*   rows of one version
    <table>/_versions/<number>           its commit: folder, rows, metrics

A replacement writes a new folder and then creates one small commit file.
Readers take the commit with the highest number, so they see the old version
until the new one is whole, and a job that fails or is killed half-way leaves
the old version as it was. Commit files are created, never overwritten: of
two writers that began from the same version one fails (``Conflict``). A
commit file that was cut short does not parse and does not count.

The version before the current one is kept for readers that are still at it;
older ones are dropped after a commit, with what failed writers left behind.

Metrics are Spark ``Observation`` aggregates over the rows on their way into
the files: they cost no second pass, and are stored with the version. Checks
compare them with figures counted from the files or from other tables.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import asdict, dataclass, field
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

KEPT = 2


class Conflict(RuntimeError):
    """Another writer has committed since this one began."""


@dataclass(frozen=True)
class Version:
    """What a commit file says. Metrics are numbers, or decimals as text; partitioned: columns that are folders."""

    number: int
    folder: str
    schema: str
    metrics: dict = field(default_factory=dict)
    notes: dict = field(default_factory=dict)

    def decimal(self, name: str) -> Decimal | None:
        v = self.metrics.get(name)
        return None if v is None else Decimal(str(v))


def _files(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _names(spark: SparkSession, folder: str) -> list[str]:
    fs, p = _files(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def _text(spark: SparkSession, path: str) -> str:
    fs, p = _files(spark, path)
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def _create(spark: SparkSession, path: str, text: str) -> None:
    """A new file; Conflict where there is one already."""
    fs, p = _files(spark, path)
    fs.mkdirs(p.getParent())
    try:
        stream = fs.create(p, False)
    except Exception as e:
        if fs.exists(p):
            raise Conflict(f"{path} was committed by another writer") from e
        raise
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def _drop(spark: SparkSession, path: str) -> None:
    fs, p = _files(spark, path)
    fs.delete(p, True)


def versions(spark: SparkSession, table: str) -> list[Version]:
    """The committed versions that are still kept, oldest first."""
    out = []
    for name in _names(spark, f"{table}/_versions"):
        try:
            out.append(Version(**json.loads(_text(spark, f"{table}/_versions/{name}"))))
        except (ValueError, TypeError):  # a writer was cut off while it wrote the commit
            continue
    return out


def current(spark: SparkSession, table: str) -> Version | None:
    found = versions(spark, table.rstrip("/"))
    return found[-1] if found else None


def folder_of(table: str, v: Version) -> str:
    return f"{table.rstrip('/')}/{v.folder}"


def read(spark: SparkSession, table: str, version: Version | None = None) -> DataFrame:
    """The rows of the current (or the given) version."""
    v = version or current(spark, table)
    if v is None:
        raise FileNotFoundError(f"{table} has no committed version")
    return spark.read.schema(StructType.fromJson(json.loads(v.schema))).parquet(folder_of(table, v))


def _plain(value):
    return str(value) if isinstance(value, Decimal) else value


def observed(df: DataFrame, metrics: dict[str, Column]) -> tuple[DataFrame, Observation]:
    """``df`` whose next action also computes ``rows`` and the metrics."""
    o = Observation(f"write-{uuid.uuid4().hex}")
    return df.observe(o, F.count(F.lit(1)).alias("rows"), *[c.alias(n) for n, c in metrics.items()]), o


def replace(df: DataFrame, table: str, metrics: dict[str, Column] | None = None, sort_within: list[str] | None = None,
            partition_by: str | None = None, notes: dict | None = None, kept: int = KEPT,
            write: Callable[[DataFrame, str], None] | None = None) -> DataFrame:
    """Write ``df`` as the next version of ``table`` and return a DataFrame that reads it.

    metrics: aggregates over the rows, observed while they are written
    (``rows`` always is). partition_by: one folder for each value, rows
    range-partitioned first, so a frequent value spans several tasks.
    write: how to write to a folder instead of as Parquet. The old version
    stays readable until the commit, and afterwards for readers at it.
    """
    spark, table = df.sparkSession, table.rstrip("/")
    before = _names(spark, f"{table}/_versions")
    number = 1 + max((int(n) for n in before), default=0)
    folder = f"_data/{number:08d}-{uuid.uuid4().hex}"
    schema = df.schema
    order = ([partition_by] if partition_by else []) + list(sort_within or [])
    if partition_by:
        df = df.repartitionByRange(*order)
    rows, o = observed(df.sortWithinPartitions(*order) if order else df, metrics or {})
    try:
        if write:
            write(rows, f"{table}/{folder}")
        else:
            w = rows.write.partitionBy(partition_by) if partition_by else rows.write
            w.parquet(f"{table}/{folder}")
        found = {k: _plain(v) for k, v in o.get.items()}
        v = Version(number, folder, schema.json(), found, notes or {})
        _create(spark, f"{table}/_versions/{number:08d}", json.dumps(asdict(v)))
    except BaseException:
        _drop(spark, f"{table}/{folder}")
        raise
    _clean(spark, table, number, kept)
    return read(spark, table, v)


def _clean(spark: SparkSession, table: str, number: int, kept: int) -> None:
    """Drop versions older than the last ``kept``, and folders up to this number that no commit names."""
    all_ = versions(spark, table)
    stay = all_[-max(kept, 1):]
    for v in all_[:-max(kept, 1)]:
        _drop(spark, f"{table}/_versions/{v.number:08d}")
    named = {v.folder for v in stay}
    for name in _names(spark, f"{table}/_data"):
        if f"_data/{name}" not in named and int(name.split("-")[0]) <= number:
            _drop(spark, f"{table}/_data/{name}")
