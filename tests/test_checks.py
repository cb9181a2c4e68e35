"""Checks pass on clean data and fail under the matching mutation."""

import datetime as dt

import pytest

from martlet import registry
from martlet.plans import checks
from martlet.plans.facts import fct_order_items
from martlet.plans.scope import Scope

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def m(spark):
    return registry.model(spark, SF)


def passed(df):
    return [r.passed for r in df.collect()]


def test_invariant_checks_pass(m):
    assert passed(checks.revenue_reconciliation(m.order_items, m.orders, m.fct_order_items, m.params.scope)) == [True]
    assert passed(checks.grain(m.fct_order_items, ["order_id", "order_item_id"], "order_id")) == [True]
    assert passed(checks.facts_agree(m.fct_order_items, m.fct_orders)) == [True]
    assert passed(checks.orphan_keys(m.fct_order_items, m.dim_product, m.dim_customer, m.dim_seller,
                                     m.dim_date)) == [True]
    assert passed(checks.breakdown_totals(m.fct_order_items, m.dim_product, m.dim_customer)) == [True]
    assert all(passed(checks.fact_counts(m.fct_order_items, m.fct_orders, m.order_items, m.orders, m.params.scope)))
    assert all(passed(checks.extract_totals(m.extract_revenue(), m.extract_delivery(), m.fct_order_items,
                                            m.fct_orders)))
    assert all(passed(checks.weekend_spot_check(m.dim_date, dt.date(1996, 1, 1))))


def test_duplicate_dimension_key_fails_breakdown(m):
    dup = m.dim_product.unionByName(m.dim_product.limit(1))
    assert passed(checks.breakdown_totals(m.fct_order_items, dup, m.dim_customer)) == [False]


def test_removed_dimension_row_fails_orphans(m):
    first = m.fct_order_items.select("product_id").limit(1)
    short = m.dim_product.join(first, "product_id", "left_anti")
    assert passed(checks.orphan_keys(m.fct_order_items, short, m.dim_customer, m.dim_seller, m.dim_date)) == [False]


def test_dropped_unknown_bucket_fails_breakdown(m):
    inner = m.dim_product.where("category_name_pt != 'unknown'")
    assert passed(checks.breakdown_totals(m.fct_order_items, inner, m.dim_customer)) == [False]


def test_widened_scope_fails_revenue_reconciliation(m):
    wide = Scope(m.params.scope.statuses, m.params.scope.lo, dt.date(2001, 1, 1))
    fact = fct_order_items(m.order_items, m.orders, wide)
    assert passed(checks.revenue_reconciliation(m.order_items, m.orders, fact, m.params.scope)) == [False]


def test_source_line_numbers_fail_grain(m, spark):
    li = spark.read.parquet(f"{SF}/lineitem.parquet").withColumnRenamed("l_orderkey", "order_id")
    r = checks.grain(li, ["order_id", "l_linenumber"], "order_id").collect()[0]
    assert r.passed is False and r.rows > r.distinct_keys


def test_expected_figures_report(m):
    from martlet.plans.scope import REFERENCE_EXPECTED_ROWS
    rows = {r.item: r for r in checks.expected_figures_report(
        m, {"raw.orders": 1500, "marts.fct_orders": 710, "marts.dim_date": 1}, "153481926.95").collect()}
    assert rows["raw.orders"].passed and rows["marts.fct_orders"].passed
    assert rows["marts.fct_order_items.revenue_net"].passed
    assert rows["marts.dim_date"].passed is False
    assert len(REFERENCE_EXPECTED_ROWS) == 16
