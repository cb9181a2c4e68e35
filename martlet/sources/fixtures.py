"""Adapter from the supplied test tables to the nine marketplace sources.

The supplied tables (TPC-H-like plus an event log) are mapped onto the raw
source shapes, column names included, so the whole pipeline - staging,
dimensions, facts, extracts, checks - runs on them unchanged. The same
mapping is written in SQL for the DuckDB oracle (``martlet.oracle``); each
rule below has the same meaning in both.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.scope import ModelParams, Scope
from ..operators.sequence import sequence_in_groups

SUPPLIED_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
                   "events", "documents", "embeddings", "pages", "benchmark", "labels",
                   "conversations")

# Fixed values of the adapter (also used by the SQL oracle):
# order status by TPC-H status; promised delivery in days by priority digit;
# review score by event type; payment perturbations (order_id modulus, amount);
# the product type treated as "no category"; the type missing from the
# translation (added back by the staging patch); geolocation latitude bounds.
STATUS_MAP = {"F": "delivered", "O": "shipped", "P": "canceled"}
PROMISE_DAYS = {"1": 3, "2": 14, "3": 30, "4": 90, "5": 365}
SCORE_MAP = {"error": 1, "view": 2, "click": 3, "signup": 4, "purchase": 5}
PAYMENT_EXTRA = ((97, "0.50"), (89, "5.00"))
PAYMENT_SPLIT_MOD = 5
PAYMENT_SPLIT_AMOUNT = "1.00"
NO_CATEGORY_TYPE = "PROMO"
UNTRANSLATED_TYPE = "LARGE"
GEO_LAT_BOUNDS = (0.0, 9000.0)

FIXTURE_PARAMS = ModelParams(
    scope=Scope(statuses=("delivered", "shipped"), lo=dt.date(1996, 1, 1), hi=dt.date(2000, 9, 1)),
    spine=None,  # derived from the data: whole years around all purchase dates
    translation_patches=((UNTRANSLATED_TYPE, UNTRANSLATED_TYPE.lower()),),
)


def _map(column: str, mapping: dict) -> F.Column:
    expr = None
    for k, v in mapping.items():
        expr = F.when(F.col(column) == k, v) if expr is None else expr.when(F.col(column) == k, v)
    return expr


def supplied(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


class FixtureSources:
    """Raw-shaped source DataFrames derived lazily from one scale folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._items: DataFrame | None = None

    def t(self, name: str) -> DataFrame:
        return supplied(self.spark, self.sf_dir, name)

    def order_items(self) -> DataFrame:
        """Items numbered 1..n within each order (the numbering pass runs
        once per adapter; payments derive from the same frame)."""
        if self._items is None:
            self._items = self._number_items()
        return self._items

    def _number_items(self) -> DataFrame:
        li = self.t("lineitem")
        price = F.col("l_extendedprice").cast("decimal(10,2)")
        numbered = sequence_in_groups(
            li, ["l_orderkey"],
            ["l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice",
             "l_quantity", "l_tax"], out="order_item_id")
        return numbered.select(
            F.col("l_orderkey").alias("order_id"),
            F.col("order_item_id").cast("int").alias("order_item_id"),
            F.col("l_partkey").alias("product_id"),
            F.col("l_suppkey").alias("seller_id"),
            F.col("l_shipdate").alias("shipping_limit_date"),
            price.alias("price"),
            F.round(price * F.col("l_tax").cast("decimal(4,2)"), 2)
             .cast("decimal(10,2)").alias("freight_value"))

    def orders(self) -> DataFrame:
        o = self.t("orders")
        ship = (self.t("lineitem").select("l_orderkey", "l_shipdate")
                .join(o.select("o_orderkey", "o_orderdate"),
                      F.col("l_orderkey") == F.col("o_orderkey"))
                .groupBy("l_orderkey")
                .agg(F.min("l_shipdate").alias("first_ship"),
                     F.min(F.when(F.col("l_shipdate") >= F.col("o_orderdate"), F.col("l_shipdate")))
                      .alias("first_ship_after_order")))
        days = _map("prio", PROMISE_DAYS)
        return (o.withColumn("prio", F.substring("o_orderpriority", 1, 1))
                .join(ship, F.col("o_orderkey") == F.col("l_orderkey"), "left")
                .select(
                    F.col("o_orderkey").alias("order_id"),
                    F.col("o_custkey").alias("customer_id"),
                    _map("o_orderstatus", STATUS_MAP).alias("order_status"),
                    F.col("o_orderdate").alias("order_purchase_timestamp"),
                    F.col("o_orderdate").alias("order_approved_at"),
                    F.col("first_ship").alias("order_delivered_carrier_date"),
                    F.when(F.col("o_orderstatus") == "F", F.col("first_ship_after_order"))
                     .alias("order_delivered_customer_date"),
                    F.timestamp_add("DAY", days, F.col("o_orderdate"))
                     .alias("order_estimated_delivery_date")))

    def order_reviews(self) -> DataFrame:
        e = self.t("events")
        return e.select(
            F.col("event_id").alias("review_id"),
            F.expr("(event_id * 7) div 10").alias("order_id"),
            _map("event_type", SCORE_MAP).cast("int").alias("review_score"),
            F.lit(None).cast("string").alias("review_comment_title"),
            F.col("props").alias("review_comment_message"),
            F.date_trunc("day", F.col("ts")).cast("timestamp_ntz").alias("review_creation_date"),
            F.col("ts").alias("review_answer_timestamp"))

    def order_payments(self) -> DataFrame:
        items = self.order_items()
        oid = F.col("order_id")
        total = F.col("items_total")
        for mod, amount in PAYMENT_EXTRA:
            total = total + F.when(oid % mod == 0, F.lit(amount).cast("decimal(10,2)")).otherwise(
                F.lit("0.00").cast("decimal(10,2)"))
        split = F.lit(PAYMENT_SPLIT_AMOUNT).cast("decimal(10,2)")
        rows = F.when(
            oid % PAYMENT_SPLIT_MOD == 0,
            F.array(F.struct(F.lit(1).alias("seq"), (F.col("total") - split).alias("value")),
                    F.struct(F.lit(2).alias("seq"), split.alias("value")))
        ).otherwise(F.array(F.struct(F.lit(1).alias("seq"), F.col("total").alias("value"))))
        return (items.groupBy("order_id")
                .agg(F.sum(F.col("price") + F.col("freight_value")).alias("items_total"))
                .withColumn("total", total.cast("decimal(10,2)"))
                .select("order_id", F.explode(rows).alias("p"))
                .select(
                    "order_id",
                    F.col("p.seq").alias("payment_sequential"),
                    F.when(oid % 2 == 0, "boleto").otherwise("credit_card").alias("payment_type"),
                    F.lit(1).alias("payment_installments"),
                    F.col("p.value").cast("decimal(10,2)").alias("payment_value")))

    def _nation(self) -> DataFrame:
        return self.t("nation").select("n_nationkey", "n_name")

    def customers(self) -> DataFrame:
        c = self.t("customer")
        return (c.join(self._nation(), F.col("c_nationkey") == F.col("n_nationkey"), "left")
                .select(
                    F.col("c_custkey").alias("customer_id"),
                    F.expr("(c_custkey * 9) div 10").alias("customer_unique_id"),
                    F.col("c_nationkey").cast("string").alias("customer_zip_code_prefix"),
                    F.col("c_mktsegment").alias("customer_city"),
                    F.col("n_name").alias("customer_state")))

    def products(self) -> DataFrame:
        p = self.t("part")
        null_d = F.lit(None).cast("double")
        null_i = F.lit(None).cast("int")
        return p.select(
            F.col("p_partkey").alias("product_id"),
            F.when(F.col("p_type") != NO_CATEGORY_TYPE, F.col("p_type")).alias("product_category_name"),
            null_i.alias("product_name_lenght"),
            null_i.alias("product_description_lenght"),
            null_i.alias("product_photos_qty"),
            F.col("p_size").cast("double").alias("product_weight_g"),
            null_d.alias("product_length_cm"),
            null_d.alias("product_height_cm"),
            null_d.alias("product_width_cm"))

    def sellers(self) -> DataFrame:
        s = self.t("supplier")
        return (s.join(self._nation(), F.col("s_nationkey") == F.col("n_nationkey"), "left")
                .select(
                    F.col("s_suppkey").alias("seller_id"),
                    F.col("s_nationkey").cast("string").alias("seller_zip_code_prefix"),
                    F.col("s_name").alias("seller_city"),
                    F.col("n_name").alias("seller_state")))

    def category_name_translation(self) -> DataFrame:
        p = self.t("part")
        return (p.select("p_type").distinct()
                .where(~F.col("p_type").isin(NO_CATEGORY_TYPE, UNTRANSLATED_TYPE))
                .select(F.col("p_type").alias("product_category_name"),
                        F.lower("p_type").alias("product_category_name_english")))

    def geolocation(self) -> DataFrame:
        c = self.t("customer")
        return (c.join(self._nation(), F.col("c_nationkey") == F.col("n_nationkey"), "left")
                .select(
                    F.col("c_nationkey").cast("string").alias("geolocation_zip_code_prefix"),
                    F.col("c_acctbal").alias("geolocation_lat"),
                    (F.col("c_acctbal") / 2).alias("geolocation_lng"),
                    F.col("c_mktsegment").alias("geolocation_city"),
                    F.col("n_name").alias("geolocation_state")))

    def raw(self) -> "LazyTables":
        return LazyTables(self, ("orders", "order_items", "order_payments", "order_reviews",
                                 "customers", "products", "sellers", "geolocation",
                                 "category_name_translation"))


# Fixed values of the flawed variant (also used by the SQL oracle): the flaws
# that the checks and profiles look for, planted by rules on the keys.
ORPHAN_SHIFT = 10_000_000
ORPHAN_PRODUCT_MOD, ORPHAN_CUSTOMER_MOD, NO_SELLER_MOD = 41, 53, 67
PLACEHOLDER_PAYMENT_MOD, UNKNOWN_PAYMENT_MOD = 71, 73
SELLERLESS_NATION_MOD = 3


class FlawedSources(FixtureSources):
    """The same sources with planted flaws: deliveries at any time of the
    day, spellings of a city that differ in case and blanks, states without
    a seller, keys without a parent row, placeholder and unknown payment
    types."""

    def orders(self) -> DataFrame:
        oid, cid = F.col("order_id"), F.col("customer_id")
        minutes = (oid * 37 % 1440).cast("int")
        return (super().orders()
                .withColumn("order_delivered_customer_date", F.timestamp_add("MINUTE", minutes, F.col("order_delivered_customer_date")))
                .withColumn("customer_id", F.when(oid % ORPHAN_CUSTOMER_MOD == 0, cid + ORPHAN_SHIFT).otherwise(cid)))

    def order_items(self) -> DataFrame:
        oid, pid = F.col("order_id"), F.col("product_id")
        return (super().order_items()
                .withColumn("product_id", F.when(pid % ORPHAN_PRODUCT_MOD == 0, pid + ORPHAN_SHIFT).otherwise(pid))
                .withColumn("seller_id", F.when(oid % NO_SELLER_MOD != 0, F.col("seller_id"))))

    def order_payments(self) -> DataFrame:
        oid = F.col("order_id")
        kind = (F.when(oid % PLACEHOLDER_PAYMENT_MOD == 0, "not_defined").when(oid % UNKNOWN_PAYMENT_MOD == 0, F.lit(None))
                .otherwise(F.col("payment_type")))
        return super().order_payments().withColumn("payment_type", kind)

    def customers(self) -> DataFrame:
        city, n = F.col("customer_city"), F.col("customer_id") % 4
        spelt = F.when(n == 0, F.lower(city)).when(n == 1, F.concat(F.lit("  "), city)).when(n == 2, F.concat(city, F.lit(" "))).otherwise(city)
        return super().customers().withColumn("customer_city", spelt)

    def sellers(self) -> DataFrame:
        has = F.col("seller_zip_code_prefix").cast("int") % SELLERLESS_NATION_MOD != 0
        return super().sellers().withColumn("seller_state", F.when(has, F.col("seller_state")))


class LazyTables(dict):
    """Mapping name -> DataFrame that builds each frame on first access."""

    def __init__(self, src: FixtureSources, names):
        super().__init__()
        self._src, self._names = src, tuple(names)

    def __missing__(self, name):
        if name not in self._names:
            raise KeyError(name)
        df = getattr(self._src, name)()
        self[name] = df
        return df

    def keys(self):
        return list(self._names)

    def __iter__(self):
        return iter(self._names)

    def __len__(self):
        return len(self._names)

    def items(self):
        return [(n, self[n]) for n in self._names]

    def values(self):
        return [self[n] for n in self._names]
