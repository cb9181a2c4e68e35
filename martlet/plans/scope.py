"""Analysis scope and the other parameters of the model.

The defaults are the reference's values; every builder takes a ``Scope`` so
other data (for example the supplied test tables) can use its own window.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

# Fixed values (must equal the reference's for identical results):
# statuses in scope, the half-open purchase window, the date-spine bounds,
# the two staging patches for the category translation and the delivery
# bucket upper edges with their labels.
REFERENCE_STATUSES = ("delivered", "shipped")
REFERENCE_LO = dt.date(2017, 1, 1)
REFERENCE_HI = dt.date(2018, 9, 1)
REFERENCE_SPINE = (dt.date(2016, 9, 1), dt.date(2018, 12, 31))
REFERENCE_TRANSLATION_PATCHES = (
    ("pc_gamer", "pc_gamer"),
    ("portateis_cozinha_e_preparadores_de_alimentos", "portable_kitchen_and_food_preparers"),
)
REFERENCE_BUCKETS = ((3, "0-3"), (7, "4-7"), (14, "8-14"), (21, "15-21"), (30, "22-30"))
REFERENCE_OPEN_BUCKET = "31+"
REFERENCE_NEGATIVE_MAX_SCORE = 2
REFERENCE_SLOW_TAIL_DAYS = 21


@dataclass(frozen=True)
class Scope:
    """Which orders the facts keep: status in ``statuses`` and
    ``lo <= purchased_at < hi`` (half-open, so the last day is whole)."""

    statuses: tuple[str, ...] = REFERENCE_STATUSES
    lo: dt.date = REFERENCE_LO
    hi: dt.date = REFERENCE_HI


@dataclass(frozen=True)
class ModelParams:
    scope: Scope = field(default_factory=Scope)
    # None: derive the date spine from the data (whole years around all
    # purchase dates) instead of fixed bounds.
    spine: tuple[dt.date, dt.date] | None = REFERENCE_SPINE
    translation_patches: tuple[tuple[str, str], ...] = REFERENCE_TRANSLATION_PATCHES
    buckets: tuple[tuple[int, str], ...] = REFERENCE_BUCKETS
    open_bucket: str = REFERENCE_OPEN_BUCKET
    negative_max_score: int = REFERENCE_NEGATIVE_MAX_SCORE
    # malformed timestamps and amounts become NULL instead of failing the
    # load (ANSI casts raise); the typed-timestamp check then reports them
    lenient_casts: bool = False


# The expected figures the reference states for its own source
# dataset (load, dimension and fact row counts, fact revenue). Used only when
# the model runs on that dataset (``expected_figures_report``); on other data
# the checks compare independently computed values instead.
REFERENCE_EXPECTED_ROWS = {
    "raw.orders": 99441,
    "raw.order_items": 112650,
    "raw.order_payments": 103886,
    "raw.order_reviews": 99224,
    "raw.customers": 99441,
    "raw.products": 32951,
    "raw.sellers": 3095,
    "raw.geolocation": 1000163,
    "raw.category_name_translation": 71,
    "staging.category_translation": 73,
    "marts.dim_date": 852,
    "marts.dim_customer": 99441,
    "marts.dim_product": 32951,
    "marts.dim_seller": 3095,
    "marts.fct_order_items": 111054,
    "marts.fct_orders": 97308,
}
REFERENCE_EXPECTED_REVENUE_NET = "13330627.12"
