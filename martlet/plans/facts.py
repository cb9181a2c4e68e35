"""The two facts: item grain (revenue) and order grain (delivery, review).

Order-level measures never sit on the item fact: an order with four items
would otherwise count four times in any delivery or review average.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.expr import fractional_days, in_window
from ..operators.dedup import latest_per_key
from .scope import REFERENCE_NEGATIVE_MAX_SCORE, Scope


def in_scope(orders: DataFrame, scope: Scope) -> Column:
    return orders["status"].isin(*scope.statuses) & in_window(orders["purchased_at"], scope.lo, scope.hi)


def scoped_orders(orders: DataFrame, scope: Scope) -> DataFrame:
    """Status and half-open purchase window; both reach the scan as pushed
    filters when orders is a Parquet table."""
    return orders.where(in_scope(orders, scope))


def fct_order_items(items: DataFrame, orders: DataFrame, scope: Scope) -> DataFrame:
    """One row per (order_id, order_item_id) of an in-scope order."""
    o = scoped_orders(orders, scope).select(
        F.col("order_id").alias("_oid"), "customer_id", "purchased_at")
    return (items.join(o, items["order_id"] == o["_oid"])
            .select("order_id", "order_item_id", "product_id", "seller_id", "customer_id",
                    F.col("purchased_at").cast("date").alias("date_key"),
                    F.col("price").alias("revenue_net"),
                    F.col("freight_value").alias("freight_cost"),
                    (F.col("price") + F.col("freight_value")).alias("revenue_gross"),
                    (F.col("price") - F.col("freight_value")).alias("contribution_after_freight")))


def reviews_deduped(reviews: DataFrame) -> DataFrame:
    """One review per order: latest created_at, then smallest review_id."""
    return latest_per_key(reviews, "order_id", "created_at", "review_id", ["review_score"])


def item_totals(items_fact: DataFrame) -> DataFrame:
    return items_fact.groupBy("order_id").agg(
        F.sum("revenue_net").alias("revenue_net"),
        F.sum("freight_cost").alias("freight_cost"),
        F.sum("contribution_after_freight").alias("contribution_after_freight"),
        F.count(F.lit(1)).alias("item_count"))


def fct_orders(orders: DataFrame, items_fact: DataFrame, reviews: DataFrame, scope: Scope,
               negative_max_score: int = REFERENCE_NEGATIVE_MAX_SCORE) -> DataFrame:
    """One row per in-scope order that has items. Undelivered orders get
    NULL delivery_days/is_late; unreviewed orders NULL is_negative_review."""
    o = scoped_orders(orders, scope)
    t = item_totals(items_fact)
    r = reviews_deduped(reviews)
    delivered = (F.col("status") == "delivered") & F.col("delivered_at").isNotNull()
    score = F.col("review_score")
    return (o.join(t, "order_id")
            .join(r, "order_id", "left")
            .select("order_id", "customer_id",
                    F.col("purchased_at").cast("date").alias("date_key"),
                    "status", "revenue_net", "freight_cost", "contribution_after_freight",
                    "item_count",
                    F.when(delivered, F.datediff("delivered_at", "purchased_at")).alias("delivery_days"),
                    F.when(delivered, F.col("delivered_at") > F.col("estimated_delivery_at"))
                     .alias("is_late"),
                    score.alias("review_score"),
                    F.when(score <= negative_max_score, True).when(score.isNotNull(), False)
                     .alias("is_negative_review")))


def fct_orders_extended(orders: DataFrame, fct: DataFrame) -> DataFrame:
    """fct_orders plus fractional delivery days and a lifecycle-order flag
    (hand-over before approval, or delivery before hand-over), for users who
    exclude such orders from delivery-time analysis."""
    o = orders.select("order_id", "approved_at", "carrier_handover_at", "delivered_at", "purchased_at")
    viol = ((F.col("carrier_handover_at") < F.col("approved_at"))
            | (F.col("delivered_at") < F.col("carrier_handover_at"))
            | (F.col("approved_at") < F.col("purchased_at"))
            | (F.col("delivered_at") < F.col("purchased_at")))
    return (fct.join(o, "order_id")
            .withColumn("delivery_days_exact",
                        F.when(F.col("delivery_days").isNotNull(),
                               fractional_days("delivered_at", "purchased_at")))
            .withColumn("has_sequence_violation", F.coalesce(viol, F.lit(False)))
            .drop("approved_at", "carrier_handover_at", "delivered_at", "purchased_at"))
