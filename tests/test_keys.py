"""One grouping for all relations, and a validation report that can fail."""

import os

import pytest
from pyspark.sql import functions as F

from martlet import registry
from martlet.operators.joins import match_counts
from martlet.operators.keys import Tag, key_usage, orphan_counts, relation_counts
from martlet.plans import checks
from martlet.plans.model import Model
from martlet.sources import versions

SF = "/root/testdata/sf0.001"


def test_relations_with_nulls_repeats_and_orphans(spark):
    parent = spark.createDataFrame([(1, "x"), (2, "x"), (2, "y"), (None, "z"), (9, None)], "id int, other string")
    child = spark.createDataFrame([(1, "x"), (1, "q"), (7, None), (None, "y"), (None, "z")], "pid int, o string")
    rel = [("a", child, "pid", parent, "id"), ("b", child, "o", parent, "other"), ("c", parent, "id", parent, "id")]
    got = {r.relation: (r.orphans, r.childless_parents) for r in relation_counts(rel).collect()}
    for name, c, ck, p, pk in rel:
        assert got[name] == tuple(match_counts(c, ck, p, pk).first()), name
    assert got["a"] == (3, 4)


def test_one_shuffle_and_one_scan_for_all_relations(spark):
    m = registry.model(spark, SF)
    df = orphan_counts(m.fct_order_items, [("p", "product_id", m.dim_product), ("s", "seller_id", m.dim_seller), ("c", "customer_id", m.dim_customer)])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan and "SortAggregate" not in plan
    assert plan.count("FileScan") == 4


def test_measures_and_empty_tables(spark):
    items = spark.createDataFrame([("k", "1.10"), ("k", "2.20"), (None, "4.00")], "id string, v string").withColumn("v", F.col("v").cast("decimal(10,2)"))
    none = items.limit(0)
    got = {r.key: (r.n_a, r.n_b, r.m_a) for r in key_usage([Tag("a", items, F.col("id"), "d", "v"), Tag("b", none, F.col("id"), "d")]).collect()}
    assert {k: (a, b, str(v)) for k, (a, b, v) in got.items()} == {"k": (2, 0, "3.30"), None: (1, 0, "4.00")}
    assert relation_counts([("r", none, "id", none, "id")]).first()[1:] == (0, 0)


def failing(report):
    return {r.check for r in report.collect() if not r.passed}


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """A lake of its own, whose files the tests spoil."""
    root = str(tmp_path_factory.mktemp("lake"))
    m = Model(spark, registry.model(spark, SF).raw, registry.model(spark, SF).params).with_raw_written(root)
    marts = m.materialize(f"{root}/marts")
    marts.write_extracts(f"{root}/extracts")
    return marts


def spoiled(m, **marts):
    new = Model(m.spark, m.raw, m.params, {**m._marts, **marts}, None, m.written, m.loaded_rows, m.lake)
    new.extract_totals = m.extract_totals
    return new


def test_report_reads_each_fact_once(stored):
    plan = checks.validation_report(stored)._jdf.queryExecution().executedPlan().toString()
    for fact in ("fct_order_items", "fct_orders"):
        assert sum(f"/marts/{fact}/" in line for line in plan.splitlines() if "FileScan" in line) == 1
    assert failing(checks.validation_report(stored)) == set()


def test_report_finds_what_was_lost_or_doubled(stored):
    items, orders = stored.fct_order_items, stored.fct_orders
    one = items.limit(1)
    assert failing(checks.validation_report(spoiled(stored, fct_order_items=items.unionAll(one)))) >= {
        "v5_fact_counts", "v6_revenue_reconciliation", "v7_grain", "v8_facts_agree", "v14_extract_totals"}
    lost = failing(checks.validation_report(spoiled(stored, fct_orders=orders.where("order_id > 20"))))
    assert lost >= {"v5_fact_counts", "v8_facts_agree", "v11_headline_kpis", "v14_extract_totals"}
    short = stored.dim_customer.where("customer_id > 10")
    assert failing(checks.validation_report(spoiled(stored, dim_customer=short))) == {"v9_orphan_keys", "v10_breakdown_totals", "v3_dim_counts"}
    days = stored.agg_delivery_days.where("delivery_days IS NULL OR delivery_days > 5")
    assert failing(checks.validation_report(spoiled(stored, agg_delivery_days=days))) == {"v11_headline_kpis"}
    weekend = stored.dim_date.withColumn("is_weekend", F.lit(False))
    assert failing(checks.validation_report(spoiled(stored, dim_date=weekend))) == {"v4_weekend_spot_check"}


def test_broken_load_fails_the_report(stored):
    raw = {t: stored.raw[t] for t in stored.raw}
    raw["order_payments"] = raw["order_payments"].where("order_id % 2 = 0")
    broken = Model(stored.spark, raw, stored.params, stored._marts, None, stored.written, stored.loaded_rows, stored.lake)
    broken.extract_totals = stored.extract_totals
    assert failing(checks.validation_report(broken)) == {"v1_load_counts"}
    assert failing(checks.validation_report(stored, expected={"orders": 1})) == {"v1_load_counts"}


def test_percentile_queries_scan_no_fact(stored):
    from martlet.plans import metrics
    for df in (metrics.delivery_time_from_days(stored.agg_delivery_days), metrics.state_scorecard(stored.agg_delivery_days),
               stored.extract_delivery(), checks.headline_kpis(stored.agg_delivery_days)):
        assert "fct_" not in df._jdf.queryExecution().executedPlan().toString()
    a = metrics.delivery_time(stored.fct_orders).first()
    assert tuple(a) == pytest.approx(tuple(metrics.delivery_time_from_days(stored.agg_delivery_days).first()))


def test_day_values_keep_orders_without_dimension_rows(stored):
    from martlet.plans.extracts import delivery_days, delivery_from_days, extract_delivery
    few = stored.dim_customer.where("customer_id % 2 = 0")
    days = delivery_days(stored.fct_orders, few, stored.dim_date.where("year > 1996"))
    assert days.agg(F.sum("orders")).first()[0] == stored.fct_orders.count()
    joined = stored.fct_orders.join(few, "customer_id").join(stored.dim_date.where("year > 1996"), "date_key")
    assert delivery_from_days(days).agg(F.sum("orders")).first()[0] == joined.count()
    assert sorted(map(tuple, extract_delivery(stored.fct_orders, stored.dim_customer, stored.dim_date).collect()), key=str) == \
        sorted(map(tuple, stored.extract_delivery().collect()), key=str)


def test_stored_model_is_the_written_one(spark, stored):
    again = Model.stored(spark, stored.lake, stored.params)
    assert again.written.keys() == stored.written.keys() and again.loaded_rows == stored.loaded_rows
    assert sorted(map(tuple, again.extract_buckets().collect())) == sorted(map(tuple, stored.extract_buckets().collect()))
    assert os.path.isdir(versions.folder_of(f"{stored.lake}/marts/fct_orders", again.written["fct_orders"]))
