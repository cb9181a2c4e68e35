"""The layered model as one object: raw -> staging -> marts.

``Model`` is lazy: every property is a DataFrame plan over the raw inputs.
``materialize`` writes dimensions and facts as the next version of their
tables (see ``sources.versions``) and returns a model that reads them back;
staging stays lazy. Facts are written sorted within partitions by their key
so min/max statistics let later scans skip row groups. Their totals are
observed while they are written and stored with the version.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import versions
from ..sources.csv import loaded_rows, stored_raw, write_extract_csv
from ..sources.schemas import RAW_SCHEMAS
from ..sources.tables import SLICE, bucket_count, heavy_keys, in_every_slice, input_bytes, register_views, save_bucketed, sliced
from . import dims, extracts, facts, staging
from .scope import ModelParams

STAGING_TABLES = tuple(staging.RULES)
MART_TABLES = ("dim_date", "dim_customer", "dim_product", "dim_seller",
               "fct_order_items", "fct_orders")
#: Built from the written facts: delivery and review measures by day value, which percentiles and rates read instead of a fact.
AGGREGATES = ("agg_delivery_days",)


def observed_totals(table: str) -> dict[str, Column]:
    """Totals observed while a table or an extract is written (its row count always is)."""
    sums = {"fct_order_items": "revenue_net freight_cost", "fct_orders": "revenue_net freight_cost item_count",
            "agg_delivery_days": "orders revenue_net", "revenue_by_category_state_month": "revenue_net items",
            "delivery_by_state_month": "revenue_net orders", "delivery_buckets": "orders"}
    return {c: F.sum(c) for c in sums.get(table, "").split()}


class Model:
    """written: for marts that were written, the version and the totals
    observed on the way; loaded_rows: rows of each raw table, observed while
    it was loaded; extract_totals: what ``write_extracts`` has observed."""

    def __init__(self, spark: SparkSession, raw: dict[str, DataFrame],
                 params: ModelParams | None = None, marts: dict[str, DataFrame] | None = None,
                 supplied=None, written: dict[str, versions.Version] | None = None,
                 loaded_rows: dict[str, int] | None = None, lake: str | None = None):
        self.spark = spark
        self.raw = raw
        self.params = params or ModelParams()
        self._marts = marts or {}
        # where the raw tables came from (an object with ``t(name)``), if any
        self.supplied = supplied
        self.written = written or {}
        self.loaded_rows = loaded_rows or {}
        self.lake = lake  # folder of the written layers, if any
        self.extract_totals: dict[str, dict] | None = None

    @classmethod
    def stored(cls, spark: SparkSession, lake: str, params: ModelParams | None = None) -> "Model":
        """The current versions of a lake folder: raw tables, marts and their observed totals."""
        root = lake.rstrip("/")
        raw = {t: stored_raw(spark, root, t) for t in RAW_SCHEMAS}
        written = {t: versions.current(spark, f"{root}/marts/{t}") for t in MART_TABLES + AGGREGATES}
        written = {t: v for t, v in written.items() if v is not None}
        marts = {t: versions.read(spark, f"{root}/marts/{t}", v) for t, v in written.items()}
        return cls(spark, raw, params, marts, written=written, loaded_rows=loaded_rows(spark, root), lake=root)

    # staging (lazy)
    def _staged(self, table: str) -> DataFrame:
        return staging.staged(table, self.raw[staging.raw_name(table)], self.params.lenient_casts, self.params.translation_patches)

    @cached_property
    def orders(self) -> DataFrame:
        return self._staged("orders")

    @cached_property
    def order_items(self) -> DataFrame:
        return self._staged("order_items")

    @cached_property
    def order_payments(self) -> DataFrame:
        return self._staged("order_payments")

    @cached_property
    def order_reviews(self) -> DataFrame:
        return self._staged("order_reviews")

    @cached_property
    def customers(self) -> DataFrame:
        return self._staged("customers")

    @cached_property
    def products(self) -> DataFrame:
        return self._staged("products")

    @cached_property
    def sellers(self) -> DataFrame:
        return self._staged("sellers")

    @cached_property
    def category_translation(self) -> DataFrame:
        return self._staged("category_translation")

    # marts
    def _mart(self, name: str, build) -> DataFrame:
        if name not in self._marts:
            self._marts[name] = build()
        return self._marts[name]

    @property
    def dim_date(self) -> DataFrame:
        def build():
            if self.params.spine is None:
                return dims.dim_date_covering(self.orders, "purchased_at")
            return dims.dim_date(self.spark, *self.params.spine)
        return self._mart("dim_date", build)

    @property
    def dim_customer(self) -> DataFrame:
        return self._mart("dim_customer", lambda: dims.dim_customer(self.customers))

    @property
    def dim_product(self) -> DataFrame:
        return self._mart("dim_product", lambda: dims.dim_product(self.products, self.category_translation))

    @property
    def dim_seller(self) -> DataFrame:
        return self._mart("dim_seller", lambda: dims.dim_seller(self.sellers))

    @property
    def fct_order_items(self) -> DataFrame:
        return self._mart("fct_order_items", lambda: facts.fct_order_items(
            self.order_items, self.orders, self.params.scope))

    @property
    def fct_orders(self) -> DataFrame:
        return self._mart("fct_orders", lambda: facts.fct_orders(
            self.orders, self.fct_order_items, self.order_reviews, self.params.scope,
            self.params.negative_max_score))

    @property
    def calendar_rows(self) -> int | None:
        """Rows of the date spine where they are known: from its bounds, or counted when it was written."""
        if "dim_date" in self.written:
            return self.written["dim_date"].metrics.get("rows")
        return (self.params.spine[1] - self.params.spine[0]).days + 1 if self.params.spine else None

    @property
    def agg_delivery_days(self) -> DataFrame:
        return self._mart("agg_delivery_days", lambda: extracts.delivery_days(
            self.fct_orders, self.joined_customer, self.dim_date, self.calendar_rows))

    # extracts
    def extract_revenue(self) -> DataFrame:
        return extracts.extract_revenue(self.fct_order_items, self.dim_product, self.joined_customer,
                                        self.dim_date, self.calendar_rows)

    def extract_delivery(self) -> DataFrame:
        return extracts.delivery_from_days(self.agg_delivery_days)

    def extract_buckets(self) -> DataFrame:
        return extracts.extract_buckets(self.fct_orders, self.params.buckets, self.params.open_bucket)

    def _extended(self, marts: dict[str, DataFrame], written: dict[str, versions.Version]) -> "Model":
        return Model(self.spark, self.raw, self.params, dict(marts), self.supplied, dict(written), self.loaded_rows, self.lake)

    def materialize(self, path: str, date_partitioned: bool = False) -> "Model":
        """Write dimensions, facts and the day-value aggregate under ``path``
        (shared storage) in dependency order, each as the next version of its
        table, and return a model whose marts read those files. With
        ``date_partitioned`` the facts get one folder per ``date_key``, so
        date-filtered reads skip whole folders."""
        root = path.rstrip("/")
        sort = {"fct_order_items": ["order_id", "order_item_id"], "fct_orders": ["order_id"]}
        out: dict[str, DataFrame] = {}
        written: dict[str, versions.Version] = {}

        def save(name: str, df: DataFrame) -> DataFrame:
            by = "date_key" if date_partitioned and name in sort else None
            return versions.replace(df, f"{root}/{name}", observed_totals(name), sort.get(name), by)

        # phase 1: dimensions and the item fact (independent, written side by
        # side); phase 2: the order fact, built from the written item fact so
        # the item join does not run twice; phase 3: the aggregate of the order fact
        for phase in (MART_TABLES[:-1], MART_TABLES[-1:], AGGREGATES):
            built = self._extended(out, written)
            frames = {name: getattr(built, name) for name in phase}
            with ThreadPoolExecutor(max_workers=min(4, len(frames))) as pool:
                futures = {name: pool.submit(save, name, df) for name, df in frames.items()}
                out.update({name: f.result() for name, f in futures.items()})
            written.update({name: versions.current(self.spark, f"{root}/{name}") for name in phase})
        return self._extended(out, written)

    def materialize_bucketed(self, schema: str, buckets: int | None = None, location: str | None = None) -> "Model":
        """Write the marts as catalog tables in ``schema``; the two facts and
        dim_customer are bucketed on customer_id, so fact-customer joins are
        co-located and shuffle neither side. The other dimensions are plain
        tables (bounded, or left to the size check). ``location`` places the
        schema on shared storage.

        buckets: by default from the measured size of the raw items and
        orders. Customers with more rows than half a bucket's share are
        parted into slices by a hash of the order: facts and
        ``dim_customer_sliced`` (a heavy customer's row once for each slice)
        are then bucketed on (customer_id, slice), which keeps the joins
        co-located and the buckets of about one size."""
        loc = f" LOCATION '{location}'" if location else ""
        self.spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema}{loc}")
        if buckets is None:
            buckets = bucket_count(sum(input_bytes(self.raw[t]) for t in ("order_items", "orders")))
        out: dict[str, DataFrame] = {}
        written: dict[str, versions.Version] = {}
        sort = {"dim_customer": ["customer_id"], "fct_order_items": ["customer_id", "order_id"],
                "fct_orders": ["customer_id", "order_id"]}
        heavy = heavy_keys(self.orders, "customer_id", buckets)
        key = ["customer_id", SLICE] if heavy else ["customer_id"]
        for phase in (MART_TABLES[:-1], MART_TABLES[-1:]):
            built = self._extended(out, written)
            for name in phase:
                table, df = f"{schema}.{name}", getattr(built, name)
                if heavy and name in ("fct_order_items", "fct_orders"):
                    df = sliced(df, "customer_id", heavy, "order_id")
                df, seen = versions.observed(df, observed_totals(name))
                if name in sort and not (heavy and name == "dim_customer"):
                    out[name] = save_bucketed(df, table, key, buckets, sort[name])
                else:
                    df.write.mode("overwrite").format("parquet").saveAsTable(table)
                    out[name] = self.spark.table(table)
                written[name] = versions.Version(0, table, out[name].schema.json(), {k: versions._plain(v) for k, v in seen.get.items()})
        if heavy:
            out["dim_customer_sliced"] = save_bucketed(in_every_slice(out["dim_customer"], "customer_id", heavy),
                                                       f"{schema}.dim_customer_sliced", key, buckets, sort["dim_customer"])
        return self._extended(out, written)

    @property
    def joined_customer(self) -> DataFrame:
        """The customer dimension that facts join to, by customer_id and, where the facts are sliced, their slice."""
        return self._marts["dim_customer_sliced"] if "dim_customer_sliced" in self._marts else self.dim_customer

    def write_extracts(self, path: str) -> dict[str, dict]:
        """Export the three dashboard extracts as CSV below ``path``, where
        the dashboards read them. Returns the totals of each, observed while
        it was written."""
        frames = {"revenue_by_category_state_month": self.extract_revenue(), "delivery_by_state_month": self.extract_delivery(),
                  "delivery_buckets": self.extract_buckets()}
        totals = {}
        for name, df in frames.items():
            rows, seen = versions.observed(df, observed_totals(name))
            write_extract_csv(rows, f"{path.rstrip('/')}/{name}")
            totals[name] = {k: versions._plain(v) for k, v in seen.get.items()}
        self.extract_totals = totals
        return totals

    def with_raw_written(self, path: str) -> "Model":
        """Write every raw table once as Parquet, the next version of
        ``path/raw/<table>``, and return a model over those files."""
        root = path.rstrip("/")
        frames = {name: self.raw[name] for name in list(self.raw.keys())}  # plans built first
        # independent writes, submitted together: Spark runs the jobs side by
        # side when one alone does not fill the executors
        with ThreadPoolExecutor(max_workers=min(4, len(frames))) as pool:
            futures = {name: pool.submit(versions.replace, df, f"{root}/raw/{name}") for name, df in frames.items()}
            raw = {name: f.result() for name, f in futures.items()}
        return Model(self.spark, raw, self.params, None, self.supplied, loaded_rows=loaded_rows(self.spark, root, names=list(raw)), lake=root)

    def staging_views(self, prefix: str = "stg_") -> list[str]:
        """Register the staging layer as temporary views (lazy, like the
        reference's staging views)."""
        return register_views({name: getattr(self, name) for name in STAGING_TABLES}, prefix)
