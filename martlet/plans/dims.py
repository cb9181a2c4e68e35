"""Dimension tables: date spine, customer, product, seller."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import calendar_columns, day_spine


def dim_date(spark: SparkSession, lo: dt.date, hi: dt.date) -> DataFrame:
    """One row per calendar day from lo to hi inclusive, so charts can show
    days without activity."""
    return (spark.range(1)
            .select(F.explode(day_spine(F.lit(lo), F.lit(hi))).alias("d"))
            .select(*calendar_columns("d")))


def dim_date_covering(df: DataFrame, ts: str) -> DataFrame:
    """Date spine over whole calendar years around every value of ``ts``:
    bounds come from one aggregate over the data, the spine is then a
    single sequence (its size is the number of days, not rows)."""
    bounds = df.agg(F.min(ts).cast("date").alias("lo"), F.max(ts).cast("date").alias("hi"))
    lo = F.trunc("lo", "year")
    hi = F.make_date(F.year("hi"), F.lit(12), F.lit(31))
    return (bounds.select(F.explode(day_spine(lo, hi)).alias("d"))
            .select(*calendar_columns("d")))


def dim_customer(customers: DataFrame) -> DataFrame:
    """Keyed on customer_id (what orders join to); the person id is an
    attribute and customer counts use it."""
    return customers.select("customer_id", "customer_unique_id", "city", "state")


def dim_product(products: DataFrame, translation: DataFrame, unknown: str = "unknown") -> DataFrame:
    """LEFT join to the translation and a literal bucket for missing
    categories: an inner join would drop products and their revenue."""
    t = translation.select(F.col("category_name_pt").alias("_pt"), "category_name_en")
    return (products.join(t, products["category_name_pt"] == t["_pt"], "left")
            .select("product_id",
                    F.coalesce(products["category_name_pt"], F.lit(unknown)).alias("category_name_pt"),
                    F.coalesce(F.col("category_name_en"), F.lit(unknown)).alias("category_name_en"),
                    "weight_g", "length_cm", "height_cm", "width_cm"))


def dim_seller(sellers: DataFrame) -> DataFrame:
    return sellers.select("seller_id", "city", "state")
