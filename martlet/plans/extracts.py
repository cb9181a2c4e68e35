"""The three dashboard extracts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.expr import bucketize, count_known, count_true
from ..sources.tables import SLICE
from .scope import REFERENCE_BUCKETS, REFERENCE_OPEN_BUCKET


#: A calendar of at most so many rows (11 bytes each) is broadcast; a larger or unknown one is left to Spark's size check.
CALENDAR_ROWS = 1_000_000


def calendar(dim_date: DataFrame, rows: int | None = None) -> DataFrame:
    """date_key -> year_month; marked for broadcast where its row count is
    known (``Model.calendar_rows``) and small."""
    c = dim_date.select("date_key", "year_month")
    return F.broadcast(c) if rows is not None and rows <= CALENDAR_ROWS else c


def _customer(fact: DataFrame, dim_customer: DataFrame) -> list[str]:
    """What a fact joins its customers by: their id, and the slice where both sides have one."""
    return ["customer_id", SLICE] if SLICE in fact.columns and SLICE in dim_customer.columns else ["customer_id"]


def extract_revenue(items_fact: DataFrame, dim_product: DataFrame, dim_customer: DataFrame,
                    dim_date: DataFrame, calendar_rows: int | None = None) -> DataFrame:
    """Revenue by category x customer state x month.

    Star join, then one aggregation (partial on the map side). A
    calendar of known size is broadcast (see ``calendar``); the customer and
    product joins are broadcast when Spark's size check allows and
    sort-merge otherwise. The customer join comes first: with the marts
    bucketed on customer_id (``Model.materialize_bucketed``) it needs no
    shuffle at all. Pre-aggregating before the customer join was
    measured and dropped: customer_id is per order, so (customer, category,
    month) hardly reduces the items and only adds a shuffle.
    """
    key = _customer(items_fact, dim_customer)
    return (items_fact
            .join(dim_customer.select(*key, "state"), key)
            .join(dim_product.select("product_id", "category_name_en"), "product_id")
            .join(calendar(dim_date, calendar_rows), "date_key")
            .groupBy("category_name_en", "state", "year_month")
            .agg(F.sum("revenue_net").alias("revenue_net"),
                 F.sum("freight_cost").alias("freight_cost"),
                 F.sum("contribution_after_freight").alias("contribution_after_freight"),
                 F.count(F.lit(1)).alias("items")))


_COUNTS = ("orders", "late_orders", "delivered_orders", "negative_reviews", "reviewed_orders", "revenue_net", "freight_cost")


def delivery_days(orders_fact: DataFrame, dim_customer: DataFrame, dim_date: DataFrame,
                  calendar_rows: int | None = None) -> DataFrame:
    """Delivery and review measures by (state, month, day value): counts and
    sums, which merge by addition. Every fact row is in exactly one group;
    ``known_customer`` and ``known_date`` tell whether its keys have dimension
    rows, as inner joins leave the others out. Built by one hash aggregate with map-side
    reduction; its size is bounded by states x months x day values, so exact
    percentiles over any of them take one row per day value with its
    frequency and no query on them scans the fact."""
    key = _customer(orders_fact, dim_customer)
    c = dim_customer.select(*key, "state", F.lit(True).alias("_c"))
    d = calendar(dim_date, calendar_rows).withColumn("_d", F.lit(True))
    return (orders_fact.join(c, key, "left").join(d, "date_key", "left")
            .groupBy("state", "year_month", "delivery_days", F.col("_c").isNotNull().alias("known_customer"),
                     F.col("_d").isNotNull().alias("known_date"))
            .agg(F.count(F.lit(1)).alias("orders"),
                 count_true("is_late").alias("late_orders"),
                 count_known("is_late").alias("delivered_orders"),
                 count_true("is_negative_review").alias("negative_reviews"),
                 count_known("is_negative_review").alias("reviewed_orders"),
                 F.sum("revenue_net").alias("revenue_net"),
                 F.sum("freight_cost").alias("freight_cost")))


def delivery_from_days(days: DataFrame) -> DataFrame:
    """Delivery and review measures by customer state x month, from ``delivery_days``."""
    total = {c: F.sum(c).alias(c) for c in _COUNTS}
    return (days.where("known_customer AND known_date").groupBy("state", "year_month")
            .agg(total["orders"], total["late_orders"], total["delivered_orders"],
                 F.percentile("delivery_days", 0.5, F.col("orders")).alias("median_days"),
                 F.percentile("delivery_days", 0.9, F.col("orders")).alias("p90_days"),
                 total["negative_reviews"], total["reviewed_orders"], total["revenue_net"], total["freight_cost"]))


def extract_delivery(orders_fact: DataFrame, dim_customer: DataFrame, dim_date: DataFrame) -> DataFrame:
    """The same from the fact itself. Orders are counted per (state, month,
    day value) first, so no group's rows meet and nothing falls back to
    sorting them."""
    return delivery_from_days(delivery_days(orders_fact, dim_customer, dim_date))


def with_bucket(orders_fact: DataFrame, buckets=REFERENCE_BUCKETS,
                open_bucket=REFERENCE_OPEN_BUCKET) -> DataFrame:
    """Delivered orders with their delivery-time bucket. NULL days are
    removed first; the CASE ladder would put them in the open bucket."""
    return (orders_fact.where(F.col("delivery_days").isNotNull())
            .withColumn("delivery_bucket", bucketize("delivery_days", buckets, open_bucket)))


def extract_buckets(orders_fact: DataFrame, buckets=REFERENCE_BUCKETS,
                    open_bucket=REFERENCE_OPEN_BUCKET) -> DataFrame:
    """Orders, negative and reviewed orders per delivery bucket, in bucket
    order (by the smallest day value, not the label text)."""
    return (with_bucket(orders_fact, buckets, open_bucket)
            .groupBy("delivery_bucket")
            .agg(F.count(F.lit(1)).alias("orders"),
                 count_true("is_negative_review").alias("negative_reviews"),
                 count_known("is_negative_review").alias("reviewed_orders"),
                 F.min("delivery_days").alias("_first_day"))
            .orderBy("_first_day").drop("_first_day"))
