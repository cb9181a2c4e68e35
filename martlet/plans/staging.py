"""Staging layer: rename, retype, fix unambiguous source gaps. Lazy.

Every table is a list of rules (source column, new name, type). The rules
are rendered as SQL expressions once, and both forms use that text: the
DataFrame over a raw frame (``staged``) and the catalog view over a raw
table (``view_text``), which any session of the catalog reads by name.

Row counts are preserved for every table except the category translation,
which gains the patch rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..functions.expr import MONEY
from ..plans.scope import REFERENCE_TRANSLATION_PATCHES


@dataclass(frozen=True)
class Rule:
    """One staged column; kind: "" (as it is), "timestamp" or "money"."""

    source: str
    name: str
    kind: str = ""

    def sql(self, lenient: bool = False) -> str:
        """Strict cast (ANSI: a malformed value is an error), or a lenient one
        (malformed values become NULL; the load counts them as rejects)."""
        c = f"`{self.source}`"
        if self.kind == "timestamp":
            c = f"try_to_timestamp(CAST({c} AS STRING))" if lenient else f"CAST({c} AS TIMESTAMP)"
        elif self.kind == "money":
            c = f"{'TRY_CAST' if lenient else 'CAST'}({c} AS {MONEY})"
        return f"{c} AS `{self.name}`"


def _rules(kept: str, prefix: str = "", renamed: str = "", timestamps: str = "", money: str = "") -> tuple[Rule, ...]:
    """Columns kept as they are; columns that lose the prefix of their table;
    ``source:name`` pairs; timestamps as such pairs; money."""
    pairs = [p.split(":") for p in renamed.split()]
    return (*(Rule(c, c) for c in kept.split()), *(Rule(s if n else f"{prefix}{s}", n or s) for s, n in ((p + [""])[:2] for p in pairs)),
            *(Rule(*p.split(":"), "timestamp") for p in timestamps.split()), *(Rule(c, c, "money") for c in money.split()))


# Source columns and the names of the staged ones. The customer's
# "delivered carrier date" is the hand-over to the carrier, not the delivery;
# the new name says so. customer_id is one per order, customer_unique_id the
# person. All reviews are kept (one per order is a rule of the facts). The
# name and description lengths and photo counts of products are dropped.
RULES: dict[str, tuple[Rule, ...]] = {
    "orders": _rules("order_id customer_id", renamed="order_status:status", timestamps=(
        "order_purchase_timestamp:purchased_at order_approved_at:approved_at order_delivered_carrier_date:carrier_handover_at "
        "order_delivered_customer_date:delivered_at order_estimated_delivery_date:estimated_delivery_at")),
    "order_items": _rules("order_id order_item_id product_id seller_id", timestamps="shipping_limit_date:shipping_limit_at",
                          money="price freight_value"),
    "order_payments": _rules("order_id payment_sequential payment_type payment_installments", money="payment_value"),
    "order_reviews": _rules("review_id order_id review_score", prefix="review_", renamed="comment_title comment_message",
                            timestamps="review_creation_date:created_at review_answer_timestamp:answered_at"),
    "customers": _rules("customer_id customer_unique_id", prefix="customer_", renamed="zip_code_prefix city state"),
    "products": _rules("product_id", prefix="product_",
                       renamed="product_category_name:category_name_pt weight_g length_cm height_cm width_cm"),
    "sellers": _rules("seller_id", prefix="seller_", renamed="zip_code_prefix city state"),
    "category_translation": _rules("", renamed=(
        "product_category_name:category_name_pt product_category_name_english:category_name_en")),
}

#: Raw table of a staged one, where the names differ.
RAW_NAME = {"category_translation": "category_name_translation"}


def raw_name(table: str) -> str:
    return RAW_NAME.get(table, table)


def select_list(table: str, lenient: bool = False) -> list[str]:
    return [r.sql(lenient) for r in RULES[table]]


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def patch_text(patches) -> str:
    """Literal rows of the translation as a query; the planner knows their number."""
    names = ", ".join(f"`{r.name}`" for r in RULES["category_translation"])
    return f"SELECT * FROM VALUES {', '.join(f'({_literal(a)}, {_literal(b)})' for a, b in patches)} AS patch({names})"


def view_text(table: str, source: str, lenient: bool = False, patches=()) -> str:
    """The staged table as a query over the raw table ``source``."""
    text = f"SELECT {', '.join(select_list(table, lenient))} FROM {source}"
    return f"{text} UNION ALL {patch_text(patches)}" if patches and table == "category_translation" else text


def staged(table: str, raw: DataFrame, lenient: bool = False, patches=()) -> DataFrame:
    """The staged table over a raw frame."""
    df = raw.selectExpr(*select_list(table, lenient))
    return df.unionByName(raw.sparkSession.sql(patch_text(patches))) if patches and table == "category_translation" else df


def stage_orders(raw: DataFrame, lenient: bool = False) -> DataFrame:
    return staged("orders", raw, lenient)


def stage_order_items(raw: DataFrame, lenient: bool = False) -> DataFrame:
    return staged("order_items", raw, lenient)


def stage_order_reviews(raw: DataFrame, lenient: bool = False) -> DataFrame:
    """All rows kept; one-review-per-order is a fact-layer rule."""
    return staged("order_reviews", raw, lenient)


def stage_category_translation(raw: DataFrame, patches=REFERENCE_TRANSLATION_PATCHES,
                               spark: SparkSession | None = None) -> DataFrame:
    """Source translation plus literal rows for categories it lacks."""
    return staged("category_translation", raw, patches=patches)
