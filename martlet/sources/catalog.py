"""Layers by name: raw and mart tables at their current version, staging views.

``publish`` names what a lake folder holds in the session's catalog: one
schema for each layer, an external table for each raw and mart table, and
the staging layer as catalog views over the raw tables. Views and tables
belong to the catalog, not to the session, so any session of it reads
``staging.orders`` by name. The text of the views is kept in the lake beside
the data; ``attach`` names everything again in another application's catalog
from the folder alone.

A table is pointed to its new version by one change of its location, so a
query by name sees the old rows or the new ones.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql.types import StructType

from ..plans.staging import RULES, raw_name, view_text
from . import versions

_RAW = "{raw}"  # stands for the raw schema in stored view texts


@dataclass(frozen=True)
class Layers:
    """Schema names; a prefix keeps several lakes apart in one catalog."""

    prefix: str = ""

    def schema(self, layer: str) -> str:
        return f"`{self.prefix}{layer}`"

    def table(self, layer: str, name: str) -> str:
        return f"{self.schema(layer)}.`{name}`"


def _tables(spark: SparkSession, lake: str, layer: str) -> list[str]:
    folder = f"{lake}/{layer}"
    return [n for n in versions._names(spark, folder) if versions.current(spark, f"{folder}/{n}") is not None]


def publish_table(spark: SparkSession, name: str, path: str) -> None:
    """Point the external table ``name`` to the current version of the table at ``path``."""
    v = versions.current(spark, path)
    if v is None:
        raise FileNotFoundError(f"{path} has no committed version")
    where = versions.folder_of(path, v)
    schema = StructType.fromJson(json.loads(v.schema))
    if spark.catalog.tableExists(name):
        if [(f.name, f.dataType) for f in spark.table(name).schema] == [(f.name, f.dataType) for f in schema]:
            spark.sql(f"ALTER TABLE {name} SET LOCATION '{where}'")
            spark.catalog.refreshTable(name)
            return
        spark.sql(f"DROP TABLE {name}")
    # folders of a partitioned version are found from its path
    parted = any("=" in n for n in versions._names(spark, where))
    spark.catalog.createTable(name, path=where, source="parquet", schema=None if parted else schema)


def save_views(spark: SparkSession, lake: str, lenient: bool = False, patches=()) -> dict[str, str]:
    """Keep the staging views' text in the lake; a new definition is a new version."""
    texts = {t: view_text(t, f"{_RAW}.`{raw_name(t)}`", lenient, patches) for t in RULES}
    folder = f"{lake.rstrip('/')}/staging/_views"
    newest = _views(spark, lake)
    if newest != texts:
        number = 1 + max((int(n) for n in versions._names(spark, folder)), default=0)
        versions._create(spark, f"{folder}/{number:08d}", json.dumps(texts))
    return texts


def _views(spark: SparkSession, lake: str) -> dict[str, str]:
    folder, texts = f"{lake.rstrip('/')}/staging/_views", {}
    for n in versions._names(spark, folder):
        try:
            texts = json.loads(versions._text(spark, f"{folder}/{n}"))
        except ValueError:
            continue
    return texts


def attach(spark: SparkSession, lake: str, prefix: str = "") -> Layers:
    """Name all tables and views of a lake folder in this session's catalog; nothing is computed."""
    lake, layers = lake.rstrip("/"), Layers(prefix)
    for layer in ("raw", "staging", "marts"):
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {layers.schema(layer)} LOCATION '{lake}/_schemas/{layer}'")
    for layer in ("raw", "marts"):
        for name in _tables(spark, lake, layer):
            publish_table(spark, layers.table(layer, name), f"{lake}/{layer}/{name}")
    for name, text in _views(spark, lake).items():
        spark.sql(f"CREATE OR REPLACE VIEW {layers.table('staging', name)} AS {text.replace(_RAW, layers.schema('raw'))}")
    return layers


def publish(spark: SparkSession, lake: str, prefix: str = "", lenient: bool = False, patches=()) -> Layers:
    """Keep the staging definitions in the lake and name all its tables and views."""
    save_views(spark, lake, lenient, patches)
    return attach(spark, lake, prefix)


def withdraw(spark: SparkSession, layers: Layers) -> None:
    """Take the names out of the catalog; the files stay."""
    for layer in ("staging", "raw", "marts"):
        spark.sql(f"DROP SCHEMA IF EXISTS {layers.schema(layer)} CASCADE")
