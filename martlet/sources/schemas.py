"""Explicit schemas of the nine marketplace CSV sources (raw layer).

Timestamps and money are read as strings and typed in staging: no schema
inference pass over the files, and money goes string -> decimal without a
detour through double. Zip prefixes are strings so leading zeros survive.
"""

from __future__ import annotations

from pyspark.sql.types import DoubleType, IntegerType, StringType, StructField, StructType


def _schema(*cols: tuple[str, object]) -> StructType:
    return StructType([StructField(n, t, True) for n, t in cols])


S, I, D = StringType(), IntegerType(), DoubleType()

# Source column names exactly as in the CSV headers.
RAW_SCHEMAS: dict[str, StructType] = {
    "orders": _schema(
        ("order_id", S), ("customer_id", S), ("order_status", S),
        ("order_purchase_timestamp", S), ("order_approved_at", S),
        ("order_delivered_carrier_date", S), ("order_delivered_customer_date", S),
        ("order_estimated_delivery_date", S)),
    "order_items": _schema(
        ("order_id", S), ("order_item_id", I), ("product_id", S), ("seller_id", S),
        ("shipping_limit_date", S), ("price", S), ("freight_value", S)),
    "order_payments": _schema(
        ("order_id", S), ("payment_sequential", I), ("payment_type", S),
        ("payment_installments", I), ("payment_value", S)),
    "order_reviews": _schema(
        ("review_id", S), ("order_id", S), ("review_score", I),
        ("review_comment_title", S), ("review_comment_message", S),
        ("review_creation_date", S), ("review_answer_timestamp", S)),
    "customers": _schema(
        ("customer_id", S), ("customer_unique_id", S), ("customer_zip_code_prefix", S),
        ("customer_city", S), ("customer_state", S)),
    "products": _schema(
        ("product_id", S), ("product_category_name", S), ("product_name_lenght", I),
        ("product_description_lenght", I), ("product_photos_qty", I),
        ("product_weight_g", D), ("product_length_cm", D), ("product_height_cm", D),
        ("product_width_cm", D)),
    "sellers": _schema(
        ("seller_id", S), ("seller_zip_code_prefix", S), ("seller_city", S),
        ("seller_state", S)),
    "geolocation": _schema(
        ("geolocation_zip_code_prefix", S), ("geolocation_lat", D), ("geolocation_lng", D),
        ("geolocation_city", S), ("geolocation_state", S)),
    "category_name_translation": _schema(
        ("product_category_name", S), ("product_category_name_english", S)),
}

# Default file name of each table inside a landing folder; callers with other
# names pass their own mapping to ``load_raw_layer``.
RAW_FILES: dict[str, str] = {name: f"{name}.csv" for name in RAW_SCHEMAS}

RAW_TABLES = tuple(RAW_SCHEMAS)
