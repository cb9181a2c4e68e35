"""Reconciliation checks (V1-V14). Each returns a small DataFrame with the
compared values and a ``passed`` column; ``expected`` values are either
parameters or computed independently from another path through the data,
so the invariant checks hold on any input.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType, TimestampType

from ..functions.expr import pct
from ..operators.joins import key_counts, sum_through
from ..operators.keys import Tag, key_usage, orphan_counts, unmatched
from ..operators.stack import row_count, union_all
from .facts import scoped_orders
from .scope import Scope


def spine_days(dim_date: DataFrame) -> Column:
    """Days between the first and last date of a spine, inclusive: the row
    count of a gap-free spine without duplicates."""
    return dim_date.agg(F.datediff(F.max("date_key"), F.min("date_key")) + 1).scalar()


def _expected_frame(spark, expected: dict[str, int | None] | DataFrame | None, label: str) -> DataFrame | None:
    if expected is None or isinstance(expected, DataFrame):
        return expected
    rows = [(k, v) for k, v in expected.items()]
    return spark.createDataFrame(rows, f"{label} string, expected bigint")


def load_counts(raw: dict[str, DataFrame], expected: dict[str, int | None] | DataFrame) -> DataFrame:
    """V1: rows per raw table against the source's documented count.
    ``expected`` is a dict or a (table_name, expected) DataFrame; tables
    without an expectation get NULL expected and NULL passed."""
    counts = union_all([row_count(df, name) for name, df in raw.items()])
    spark = next(iter(raw.values())).sparkSession
    exp = _expected_frame(spark, expected, "table_name")
    return (counts.join(exp, "table_name", "left")
            .select("table_name", "rows", "expected",
                    F.when(F.col("expected").isNotNull(), F.col("rows") == F.col("expected")).alias("passed")))


#: Staged timestamp of an order -> raw column.
ORDER_TIMESTAMPS = {"purchased_at": "order_purchase_timestamp", "approved_at": "order_approved_at",
                    "carrier_handover_at": "order_delivered_carrier_date",
                    "delivered_at": "order_delivered_customer_date",
                    "estimated_delivery_at": "order_estimated_delivery_date"}


def staging_pairs(m) -> dict[str, tuple[DataFrame, DataFrame]]:
    """Staged table -> (raw frame, staged frame) of a ``Model``."""
    raw_name = {"category_translation": "category_name_translation"}
    return {t: (m.raw[raw_name.get(t, t)], getattr(m, t))
            for t in ("orders", "order_items", "order_payments", "order_reviews", "customers", "products",
                      "sellers", "category_translation")}


def raw_vs_staging(pairs: dict[str, tuple[DataFrame, DataFrame]], extra_rows: dict[str, int]) -> DataFrame:
    """V2: staging keeps every raw row; only tables named in ``extra_rows``
    may grow, by exactly that many rows. Raw and staged rows are tagged,
    stacked and counted in one aggregate over all tables."""
    sides = [df.select(F.lit(name).alias("table_name"), F.lit(i).alias("_side"))
             for name, pair in pairs.items() for i, df in enumerate(pair)]
    # an empty table still has its row
    names = F.array(*[F.struct(F.lit(n).alias("table_name"), F.lit(-1).alias("_side")) for n in pairs])
    sides.append(next(iter(pairs.values()))[0].sparkSession.range(1).select(F.inline(names)))
    extra = F.create_map(*[F.lit(x) for n in pairs for x in (n, extra_rows.get(n, 0))])
    return (union_all(sides).groupBy("table_name")
            .agg(F.count_if(F.col("_side") == 0).alias("raw_rows"), F.count_if(F.col("_side") == 1).alias("staging_rows"))
            .withColumn("expected_extra", extra[F.col("table_name")].cast("bigint"))
            .withColumn("passed", F.col("staging_rows") - F.col("raw_rows") == F.col("expected_extra")))


def dimension_counts(dims: dict[str, DataFrame], sources: dict[str, DataFrame | Column | int]) -> DataFrame:
    """V3 (counts): every dimension has one row per source row. A source
    is a DataFrame (its row count), a scalar Column or an int."""
    frames = []
    for name, df in dims.items():
        src = sources[name]
        if isinstance(src, DataFrame):
            exp = src.agg(F.count(F.lit(1))).scalar()
        elif isinstance(src, Column):
            exp = src.cast("bigint")
        else:
            exp = F.lit(src).cast("bigint")
        frames.append(df.agg(F.count(F.lit(1)).alias("rows"))
                      .select(F.lit(name).alias("dimension"), "rows", exp.alias("expected")))
    return union_all(frames).withColumn("passed", F.col("rows") == F.col("expected"))


def dim_product_detail(dim_product: DataFrame, unknown: str = "unknown") -> DataFrame:
    """V3 (product): total, NULL English names (must be 0), unknown bucket."""
    return dim_product.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("category_name_en").isNull()).alias("null_english"),
        F.count_if(F.col("category_name_en") == unknown).alias("unknown_bucket"),
    ).withColumn("passed", F.col("null_english") == 0)


def dim_customer_detail(dim_customer: DataFrame) -> DataFrame:
    """V3 (customer): rows and distinct persons."""
    per_person = dim_customer.groupBy("customer_unique_id").agg(F.count(F.lit(1)).alias("n"))
    return per_person.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
                          F.count("customer_unique_id").alias("distinct_people"))


def weekend_spot_check(dim_date: DataFrame, week_start: dt.date) -> DataFrame:
    """V4: one week of the calendar; Saturday and Sunday must be weekend."""
    end = week_start + dt.timedelta(days=6)
    return (dim_date.where(F.col("date_key").between(F.lit(week_start), F.lit(end)))
            .select("date_key", "day_of_week_name", "is_weekend",
                    (F.col("is_weekend") == F.col("day_of_week_name").isin("Saturday", "Sunday"))
                    .alias("passed"))
            .orderBy("date_key"))


def fact_counts(items_fact: DataFrame, orders_fact: DataFrame, items: DataFrame, orders: DataFrame,
                scope: Scope) -> DataFrame:
    """V5: fact rows against an independent recount from staging: scoped
    items, and scoped orders that have at least one item."""
    so = scoped_orders(orders, scope).select("order_id")
    # items counted per order first; the join then matches orders, not items
    matched = key_counts(items, "order_id", "n").join(so, F.col("_k") == F.col("order_id"))
    exp_items = matched.agg(F.coalesce(F.sum("n"), F.lit(0))).scalar()
    exp_orders = matched.select("_k").distinct().agg(F.count(F.lit(1))).scalar()
    a = items_fact.agg(F.count(F.lit(1)).alias("rows")).select(
        F.lit("fct_order_items").alias("fact_table"), "rows", exp_items.alias("expected"))
    b = orders_fact.agg(F.count(F.lit(1)).alias("rows")).select(
        F.lit("fct_orders").alias("fact_table"), "rows", exp_orders.alias("expected"))
    return a.unionByName(b).withColumn("passed", F.col("rows") == F.col("expected"))


def revenue_reconciliation(items: DataFrame, orders: DataFrame, items_fact: DataFrame,
                           scope: Scope) -> DataFrame:
    """V6: revenue in the filtered source equals fact revenue, exactly
    (NULL-safe: two empty inputs agree)."""
    so = scoped_orders(orders, scope).select("order_id")
    src = sum_through(items, so, "order_id", [], {"r": "price"}).select(F.round("r", 2)).scalar()
    return (items_fact.agg(F.round(F.sum("revenue_net"), 2).alias("fact_revenue"))
            .select(src.alias("source_revenue"), "fact_revenue")
            .withColumn("passed", F.col("source_revenue").eqNullSafe(F.col("fact_revenue"))))


def grain(df: DataFrame, keys: list[str], parent: str) -> DataFrame:
    """V7: rows equal distinct keys (no duplicates at the declared grain);
    also distinct parents. One grouping on the full key; parents are
    counted from the grouped keys, so no multi-distinct expansion."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    complete = F.greatest(*[F.col(k).isNull() for k in keys]) == F.lit(False)
    parents = per_key.where(F.col(parent).isNotNull()).select(parent).distinct()
    return (per_key.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
                        F.count_if(complete).alias("distinct_keys"))
            .select("rows", "distinct_keys", parents.agg(F.count(F.lit(1))).scalar().alias("distinct_orders"))
            .withColumn("passed", F.col("rows") == F.col("distinct_keys")))


def facts_agree(items_fact: DataFrame, orders_fact: DataFrame) -> DataFrame:
    """V8: both facts carry the same revenue."""
    return (items_fact.agg(F.round(F.sum("revenue_net"), 2).alias("items_total"))
            .select("items_total",
                    orders_fact.agg(F.round(F.sum("revenue_net"), 2)).scalar().alias("orders_total"))
            .withColumn("passed", F.col("items_total").eqNullSafe(F.col("orders_total"))))


def orphan_keys(items_fact: DataFrame, dim_product: DataFrame, dim_customer: DataFrame,
                dim_seller: DataFrame, dim_date: DataFrame) -> DataFrame:
    """V9: fact keys without a dimension row, per dimension (all must be 0).
    The fact is scanned once and its four keys share one grouping."""
    out = orphan_counts(items_fact, [("orphan_products", "product_id", dim_product), ("orphan_customers", "customer_id", dim_customer),
                                     ("orphan_sellers", "seller_id", dim_seller), ("orphan_dates", "date_key", dim_date)])
    return out.withColumn("passed", F.col("orphan_products") + F.col("orphan_customers")
                          + F.col("orphan_sellers") + F.col("orphan_dates") == 0)


def breakdown_totals(items_fact: DataFrame, dim_product: DataFrame, dim_customer: DataFrame) -> DataFrame:
    """Revenue through the product and the customer join equals the
    fact total (catches a dropped unknown bucket and join fan-out)."""
    via_cat = sum_through(items_fact, dim_product, "product_id", [], {"r": "revenue_net"}) \
        .select(F.round("r", 2)).scalar()
    via_state = sum_through(items_fact, dim_customer, "customer_id", [], {"r": "revenue_net"}) \
        .select(F.round("r", 2)).scalar()
    return (items_fact.agg(F.round(F.sum("revenue_net"), 2).alias("total"))
            .select(via_cat.alias("revenue_via_category"), via_state.alias("revenue_via_state"), "total")
            .withColumn("passed", F.col("revenue_via_category").eqNullSafe(F.col("total"))
                        & F.col("revenue_via_state").eqNullSafe(F.col("total"))))


def headline_kpis(days: DataFrame) -> DataFrame:
    """Orders, late %, median and p90 days, negative-review %, from the
    day-value aggregate (``extracts.delivery_days``): no fact is scanned."""
    n = F.col("orders")
    return days.agg(
        F.coalesce(F.sum(n), F.lit(0)).alias("orders"),
        F.round(pct(F.sum("late_orders"), F.sum("delivered_orders")), 1).alias("late_pct"),
        F.round(F.percentile("delivery_days", 0.5, n), 1).alias("median_days"),
        F.round(F.percentile("delivery_days", 0.9, n), 1).alias("p90_days"),
        F.round(pct(F.sum("negative_reviews"), F.sum("reviewed_orders")), 1).alias("negative_pct"))


def timestamps_typed(raw: DataFrame, staged: DataFrame, pairs: dict[str, str]) -> DataFrame:
    """Staged timestamp columns are timestamps and no non-NULL raw value
    became NULL. ``pairs`` maps staged column -> raw column; rows are
    aligned by position-free aggregation (counts of non-NULLs)."""
    raw_n = raw.agg(*[F.count(r).alias(f"_r_{c}") for c, r in pairs.items()])
    typed_n = staged.agg(F.struct(*[F.count(c).alias(c) for c in pairs])).scalar()
    rows = []
    for c in pairs:
        t = staged.schema[c].dataType
        typed = str(isinstance(t, (TimestampType, TimestampNTZType))).lower()
        rows.append(f"'{c}', '{t.simpleString()}', {typed}, _r_{c}, _s.{c}")
    long = raw_n.withColumn("_s", typed_n).select(F.expr(
        f"stack({len(rows)}, {', '.join(rows)}) as (column_name, data_type, _typed, raw_values, typed_values)"))
    return long.select("column_name", "data_type", "raw_values", "typed_values",
                       (F.col("_typed") & (F.col("raw_values") == F.col("typed_values"))).alias("passed"))


def timestamp_spot_check(orders: DataFrame, n: int = 5) -> DataFrame:
    """A few delivered orders with datediff(end, start) (argument
    order: end first). Ordered by order_id so the sample is stable."""
    return (orders.where(F.col("delivered_at").isNotNull())
            .select("order_id", "purchased_at", "delivered_at",
                    F.datediff("delivered_at", "purchased_at").alias("delivery_days"))
            .orderBy("order_id").limit(n))


def extract_totals(revenue_extract: DataFrame, delivery_extract: DataFrame, items_fact: DataFrame,
                   orders_fact: DataFrame) -> DataFrame:
    """Exported extracts carry the fact totals (revenue and items;
    orders and revenue)."""
    rx = revenue_extract.agg(F.sum("revenue_net").alias("r"), F.sum("items").alias("i"))
    dx = delivery_extract.agg(F.sum("revenue_net").alias("r"), F.sum("orders").alias("o"))
    fi = items_fact.agg(F.sum("revenue_net").alias("r"), F.count(F.lit(1)).alias("i"))
    fo = orders_fact.agg(F.sum("revenue_net").alias("r"), F.count(F.lit(1)).alias("o"))
    out = rx.select(
        F.col("r").alias("revenue_extract_total"), fi.select("r").scalar().alias("items_fact_total"),
        F.col("i").alias("revenue_extract_items"), fi.select("i").scalar().alias("items_fact_rows"),
        dx.select("r").scalar().alias("delivery_extract_total"),
        fo.select("r").scalar().alias("orders_fact_total"),
        dx.select("o").scalar().alias("delivery_extract_orders"),
        fo.select("o").scalar().alias("orders_fact_rows"))
    return out.withColumn("passed", F.col("revenue_extract_total").eqNullSafe(F.col("items_fact_total"))
                          & (F.coalesce("revenue_extract_items", F.lit(0)) == F.col("items_fact_rows"))
                          & F.col("delivery_extract_total").eqNullSafe(F.col("orders_fact_total"))
                          & (F.coalesce("delivery_extract_orders", F.lit(0)) == F.col("orders_fact_rows")))



def first_week(dim_date: DataFrame) -> Column:
    """The first Monday of a spine, as a scalar."""
    return dim_date.where(F.dayofweek("date_key") == 2).agg(F.min("date_key")).scalar()


def fact_recount(m) -> DataFrame:
    """One row with every figure that the checks need from the marts: rows,
    distinct keys and revenue of both facts, orphan keys, revenue through the
    dimensions. Each fact and each dimension is scanned once; all keys share
    one grouping."""
    items, money_ = m.fct_order_items, "revenue_net"
    # length-prefixed, so two pairs never give one text
    grain_key = F.when(F.col("order_id").isNotNull() & F.col("order_item_id").isNotNull(),
                       F.concat_ws(":", F.length(F.col("order_id").cast("string")), "order_id", "order_item_id"))
    tags = [Tag("line", items, grain_key, "line", money_),
            Tag("product", items, F.col("product_id"), "product", money_), Tag("dim_product", m.dim_product, F.col("product_id"), "product"),
            Tag("customer", items, F.col("customer_id"), "customer", money_), Tag("dim_customer", m.dim_customer, F.col("customer_id"), "customer"),
            Tag("seller", items, F.col("seller_id"), "seller"), Tag("dim_seller", m.dim_seller, F.col("seller_id"), "seller"),
            Tag("date", items, F.col("date_key"), "date"), Tag("dim_date", m.dim_date, F.col("date_key"), "date"),
            Tag("parent", items, F.col("order_id"), "order"), Tag("order", m.fct_orders, F.col("order_id"), "order", money_)]

    def through(tag: str, dim: str) -> Column:
        # a dimension key that occurs twice multiplies its sum, as the join would
        return F.sum(F.when(F.col("key").isNotNull() & (F.col("domain") == tag), F.col(f"m_{tag}") * F.col(f"n_{dim}")))

    return key_usage(tags).agg(
        F.coalesce(F.sum("n_line"), F.lit(0)).alias("items_rows"), F.sum("m_line").alias("items_revenue"),
        F.count_if((F.col("domain") == "line") & F.col("key").isNotNull()).alias("items_keys"),
        F.coalesce(F.sum("n_order"), F.lit(0)).alias("orders_rows"), F.sum("m_order").alias("orders_revenue"),
        F.count_if((F.col("domain") == "order") & F.col("key").isNotNull() & (F.col("n_order") > 0)).alias("orders_keys"),
        unmatched("parent", "order", "order").alias("items_without_order"), unmatched("order", "parent", "order").alias("orders_without_item"),
        unmatched("product", "dim_product", "product").alias("orphan_products"), unmatched("customer", "dim_customer", "customer").alias("orphan_customers"),
        unmatched("seller", "dim_seller", "seller").alias("orphan_sellers"), unmatched("date", "dim_date", "date").alias("orphan_dates"),
        through("product", "dim_product").alias("via_category"), through("customer", "dim_customer").alias("via_state"))


def source_recount(items: DataFrame, orders: DataFrame, scope: Scope) -> DataFrame:
    """The facts' rows and revenue counted from staging by another path:
    items per order, then the orders in scope. One scan of each table."""
    per = items.groupBy(F.col("order_id").alias("_k")).agg(F.count(F.lit(1)).alias("n"), F.sum("price").alias("r"))
    own = per.join(scoped_orders(orders, scope).select("order_id"), F.col("_k") == F.col("order_id"))
    return own.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("items"), F.count(F.lit(1)).alias("orders"), F.sum("r").alias("revenue"))


def _figure(value, kind: str = "decimal(38,2)") -> Column:
    return F.lit(None if value is None else str(value)).cast(kind)


def validation_report(m, week_start: dt.date | None = None, expected: dict[str, int] | None = None) -> DataFrame:
    """All model checks as one report, (check, passed): the validation
    script to run after any change to dimensions or facts. A check without a
    row or with an unknown outcome has failed. ``m`` is a ``Model``.

    The totals of V5 to V8 and V14 exist three times: observed while facts
    and extracts were written (``Model.written``, ``Model.extract_totals``),
    recounted from the written files, and counted from staging. They must
    all agree; each fact is read once for all of V5 to V10. Where a model was
    not written, there is nothing observed to compare. expected: documented
    rows of raw tables for V1, which otherwise compares the rows stored with
    the rows observed while they were loaded. The calendar is checked over
    the week of ``week_start``, or the first whole week of the spine.
    """
    spark, scope = m.spark, m.params.scope
    seen = {t: m.written[t].metrics for t in ("fct_order_items", "fct_orders") if t in m.written}
    totals = m.extract_totals or {}
    src = source_recount(m.order_items, m.orders, scope)
    one = fact_recount(m).withColumn("s", src.select(F.struct("items", "orders", "revenue")).scalar())
    c = F.col

    def observed(table: str, name: str, figure: Column) -> Column:
        if table not in seen:
            return F.lit(True)
        kind = "bigint" if name == "rows" else "decimal(38,2)"
        return figure.cast(kind).eqNullSafe(_figure(seen[table].get(name), kind))

    def exported(extract: str, name: str, figure: Column) -> Column:
        kind = "decimal(38,2)" if name == "revenue_net" else "bigint"
        value = _figure(totals[extract].get(name), kind)
        return figure.cast(kind).eqNullSafe(value if name == "revenue_net" else F.coalesce(value, F.lit(0)))

    checks = {
        "v5_fact_counts": (c("items_rows") == c("s.items")) & (c("orders_rows") == c("s.orders"))
        & observed("fct_order_items", "rows", c("items_rows")) & observed("fct_orders", "rows", c("orders_rows")),
        "v6_revenue_reconciliation": c("items_revenue").eqNullSafe(c("s.revenue")) & observed("fct_order_items", "revenue_net", c("items_revenue")),
        "v7_grain": (c("items_rows") == c("items_keys")) & (c("orders_rows") == c("orders_keys")),
        "v8_facts_agree": c("items_revenue").eqNullSafe(c("orders_revenue")) & observed("fct_orders", "revenue_net", c("orders_revenue"))
        & (c("items_without_order") == 0) & (c("orders_without_item") == 0),
        "v9_orphan_keys": c("orphan_products") + c("orphan_customers") + c("orphan_sellers") + c("orphan_dates") == 0,
        "v10_breakdown_totals": c("via_category").eqNullSafe(c("items_revenue")) & c("via_state").eqNullSafe(c("items_revenue")),
    }
    if totals:
        rx, dx = "revenue_by_category_state_month", "delivery_by_state_month"
        checks["v14_extract_totals"] = (exported(rx, "revenue_net", c("items_revenue")) & exported(rx, "items", c("items_rows"))
                                        & exported(dx, "revenue_net", c("orders_revenue")) & exported(dx, "orders", c("orders_rows")))
    kpis = headline_kpis(m.agg_delivery_days).select("orders").scalar()
    days = m.agg_delivery_days.agg(F.struct(F.sum("revenue_net").alias("r"), F.min("late_orders").alias("l"))).scalar()
    one = one.withColumn("k", kpis).withColumn("d", days)
    checks["v11_headline_kpis"] = (c("k") == c("orders_rows")) & c("d.r").eqNullSafe(c("orders_revenue"))
    main = one.select(F.inline(F.array(*[F.struct(F.lit(n).alias("check"), F.coalesce(ok, F.lit(False)).alias("passed")) for n, ok in checks.items()])))

    if expected is not None:
        loads = load_counts(dict(m.raw.items()), expected)
        loads = loads.withColumn("passed", F.coalesce("passed", F.lit(True)))  # no figure stated for this table
    else:
        loads = load_counts(dict(m.raw.items()), m.loaded_rows).withColumn("passed", F.coalesce("passed", F.lit(True)))
    monday = F.lit(week_start) if week_start is not None else first_week(m.dim_date)
    week = m.dim_date.where(F.col("date_key").between(monday, F.date_add(monday, 6)))
    parts = {
        "v1_load_counts": loads,
        "v4_weekend_spot_check": week.select((F.col("is_weekend") == F.col("day_of_week_name").isin("Saturday", "Sunday")).alias("passed")),
        "v2_raw_vs_staging": raw_vs_staging(staging_pairs(m), {"category_translation": len(m.params.translation_patches)}),
        "v3_dim_counts": dimension_counts(
            {"dim_date": m.dim_date, "dim_customer": m.dim_customer, "dim_product": m.dim_product, "dim_seller": m.dim_seller},
            {"dim_date": spine_days(m.dim_date), "dim_customer": m.customers, "dim_product": m.products, "dim_seller": m.sellers}),
        "v3_dim_product_detail": dim_product_detail(m.dim_product),
        "v12_timestamps_typed": timestamps_typed(m.raw["orders"], m.orders, ORDER_TIMESTAMPS),
    }
    if not totals:  # nothing was exported: the extracts are computed
        parts["v14_extract_totals"] = extract_totals(m.extract_revenue(), m.extract_delivery(), m.fct_order_items, m.fct_orders)
    frames = [df.agg(F.coalesce(F.min(F.coalesce(F.col("passed"), F.lit(False)).cast("int")) == 1, F.lit(False)).alias("passed"))
              .select(F.lit(name).alias("check"), "passed") for name, df in parts.items()]
    return union_all([main, *frames])


def expected_figures_report(m, expected_rows: dict[str, int], expected_revenue: str | None = None) -> DataFrame:
    """Row counts per layer table and fact revenue against stated figures:
    (item, actual, expected, passed). ``expected_rows`` keys are
    ``layer.table`` (raw tables from ``m.raw``, staging and marts from the
    model)."""
    frames = []
    for key, exp in expected_rows.items():
        layer, name = key.split(".", 1)
        df = m.raw[name] if layer == "raw" else getattr(m, name)
        frames.append(df.agg(F.count(F.lit(1)).cast("string").alias("actual"))
                      .select(F.lit(key).alias("item"), "actual", F.lit(str(exp)).alias("expected")))
    if expected_revenue is not None:
        frames.append(m.fct_order_items.agg(F.round(F.sum("revenue_net"), 2).cast("string").alias("actual"))
                      .select(F.lit("marts.fct_order_items.revenue_net").alias("item"), "actual",
                              F.lit(expected_revenue).alias("expected")))
    return union_all(frames).withColumn("passed", F.col("actual") == F.col("expected"))
