"""Model rules R1-R16 on hand-made rows."""

import datetime as dt

from pyspark.sql import functions as F

from martlet.plans.model import Model
from martlet.plans.scope import ModelParams

from handmade import item_row, orders_row, raw_tables, review_row


def build(spark, orders, items, reviews=(), **kw):
    return Model(spark, raw_tables(spark, orders, items, reviews, **kw), ModelParams())


def rows(df, *cols):
    return {tuple(r[c] for c in cols) for r in df.collect()}


def test_half_open_window_keeps_last_day(spark):
    m = build(spark, [orders_row("in", purchased="2018-08-31 23:59:59"),
                      orders_row("out", purchased="2018-09-01 00:00:00"),
                      orders_row("before", purchased="2016-12-31 23:59:59")],
              [item_row("in"), item_row("out"), item_row("before")])
    assert {r.order_id for r in m.fct_order_items.collect()} == {"in"}
    assert {r.order_id for r in m.fct_orders.collect()} == {"in"}


def test_status_scope(spark):
    m = build(spark, [orders_row("d"), orders_row("s", status="shipped", delivered=None),
                      orders_row("c", status="canceled", delivered=None)],
              [item_row("d"), item_row("s"), item_row("c")])
    assert {r.order_id for r in m.fct_orders.collect()} == {"d", "s"}


def test_review_dedup_latest_then_smallest_id(spark):
    m = build(spark, [orders_row("o1"), orders_row("o2")], [item_row("o1"), item_row("o2")],
              [review_row("b", "o1", 5, "2017-05-06 00:00:00"), review_row("a", "o1", 1, "2017-05-06 00:00:00"),
               review_row("x", "o2", 5, "2017-05-06 00:00:00"), review_row("y", "o2", 1, "2017-05-07 00:00:00")])
    got = rows(m.fct_orders, "order_id", "review_score")
    assert got == {("o1", 1), ("o2", 1)}


def test_review_dedup_nulls_last(spark):
    m = build(spark, [orders_row("o1")], [item_row("o1")],
              [review_row("a", "o1", 1, None), review_row("b", "o1", 5, "2017-01-01 00:00:00")])
    assert rows(m.fct_orders, "order_id", "review_score") == {("o1", 5)}


def test_itemless_order_in_neither_fact(spark):
    m = build(spark, [orders_row("o1"), orders_row("empty")], [item_row("o1")])
    assert {r.order_id for r in m.fct_orders.collect()} == {"o1"}
    assert {r.order_id for r in m.fct_order_items.collect()} == {"o1"}


def test_undelivered_and_missing_date_are_null(spark):
    m = build(spark, [orders_row("s", status="shipped", delivered=None),
                      orders_row("d_nodate", delivered=None)],
              [item_row("s"), item_row("d_nodate")])
    got = rows(m.fct_orders, "order_id", "delivery_days", "is_late", "revenue_net")
    assert {(o, d, late) for o, d, late, _ in got} == {("s", None, None), ("d_nodate", None, None)}
    assert all(rev is not None for *_, rev in got)


def test_unreviewed_is_null_and_rate_ignores_it(spark):
    from martlet.plans.metrics import negative_review_rate
    m = build(spark, [orders_row("o1"), orders_row("o2")], [item_row("o1"), item_row("o2")],
              [review_row("a", "o1", 1)])
    assert rows(m.fct_orders, "order_id", "is_negative_review") == {("o1", True), ("o2", None)}
    r = negative_review_rate(m.fct_orders).collect()[0]
    assert (r.negative_reviews, r.reviewed_orders, r.negative_pct) == (1, 1, 100.0)


def test_all_unreviewed_group_rate_is_null(spark):
    from martlet.plans.metrics import negative_review_rate
    m = build(spark, [orders_row("o1")], [item_row("o1")])
    r = negative_review_rate(m.fct_orders).collect()[0]
    assert r.reviewed_orders == 0 and r.negative_pct is None


def test_missing_category_and_patch(spark):
    m = Model(spark, raw_tables(spark, [orders_row("o1")], [item_row("o1", product="p2"), item_row("o1", 2, "p3")],
                                products=[("p2", None, None, None, None, 1.0, 1.0, 1.0, 1.0),
                                          ("p3", "pc_gamer", None, None, None, 1.0, 1.0, 1.0, 1.0)]),
              ModelParams())
    assert rows(m.dim_product, "product_id", "category_name_pt", "category_name_en") == {
        ("p2", "unknown", "unknown"), ("p3", "pc_gamer", "pc_gamer")}


def test_delivery_across_midnight_counts_one_day(spark):
    m = build(spark, [orders_row("o1", purchased="2017-05-01 23:58:00", delivered="2017-05-02 00:03:00")],
              [item_row("o1")])
    assert rows(m.fct_orders, "delivery_days") == {(1,)}


def test_bucket_edges_and_null_days(spark):
    from martlet.plans.extracts import with_bucket
    edges = [3, 4, 7, 8, 14, 15, 21, 22, 30, 31]
    labels = ["0-3", "4-7", "4-7", "8-14", "8-14", "15-21", "15-21", "22-30", "22-30", "31+"]
    df = spark.createDataFrame([(d,) for d in edges] + [(None,)], "delivery_days int")
    got = [(r.delivery_days, r.delivery_bucket) for r in with_bucket(df).orderBy("delivery_days").collect()]
    assert got == list(zip(edges, labels))


def test_buckets_ordered_by_days_not_label(spark):
    m = build(spark, [orders_row("a", delivered="2017-05-02 10:00:00"),
                      orders_row("b", delivered="2017-06-30 10:00:00"),
                      orders_row("c", delivered="2017-05-12 10:00:00")],
              [item_row("a"), item_row("b"), item_row("c")])
    assert [r.delivery_bucket for r in m.extract_buckets().collect()] == ["0-3", "8-14", "31+"]


def test_late_compares_full_timestamps(spark):
    m = build(spark, [orders_row("o1", delivered="2017-05-10 08:00:00", estimated="2017-05-10 00:00:00")],
              [item_row("o1")])
    assert rows(m.fct_orders, "is_late") == {(True,)}


def test_weekday_numbering(spark):
    from martlet.plans.dims import dim_date
    d = dim_date(spark, dt.date(2017, 1, 2), dt.date(2017, 1, 8)).collect()
    assert [(r.day_of_week_name, r.day_of_week_number, r.is_weekend) for r in d] == [
        ("Monday", 2, False), ("Tuesday", 3, False), ("Wednesday", 4, False), ("Thursday", 5, False),
        ("Friday", 6, False), ("Saturday", 7, True), ("Sunday", 1, True)]
    assert dim_date(spark, dt.date(2016, 9, 1), dt.date(2018, 12, 31)).count() == 852


def test_two_items_three_payments_not_multiplied(spark):
    from martlet.operators.profile import reconcile
    m = build(spark, [orders_row("o1")], [item_row("o1", 1, price="10.00", freight="0.00"),
                                          item_row("o1", 2, price="20.00", freight="0.00")],
              payments=[("o1", 1, "credit_card", 1, "10.00"), ("o1", 2, "voucher", 1, "10.00"),
                        ("o1", 3, "voucher", 1, "10.00")])
    items = m.order_items.withColumn("amount", F.col("price") + F.col("freight_value"))
    r = reconcile(items, m.order_payments, "order_id", "amount", "payment_value").collect()[0]
    assert float(r.total_a) == 30.0 and float(r.total_b) == 30.0 and r.differ_gt_0_01 == 0


def test_money_is_exact_decimal(spark):
    m = build(spark, [orders_row("o1")], [item_row("o1", i, price="0.10", freight="0.20") for i in range(1, 11)])
    r = m.fct_orders.collect()[0]
    assert str(r.revenue_net) == "1.00" and str(r.contribution_after_freight) == "-1.00"


def test_lenient_timestamps_become_null(spark):
    import pytest
    from martlet.plans.checks import timestamps_typed
    from martlet.plans.staging import stage_orders
    raw = raw_tables(spark, [orders_row("o1"), orders_row("o2", delivered="not a time")], [])["orders"]
    with pytest.raises(Exception):
        stage_orders(raw).collect()
    lenient = stage_orders(raw, lenient=True)
    assert {r.order_id: r.delivered_at for r in lenient.collect()}["o2"] is None
    rep = {r.column_name: r.passed for r in timestamps_typed(raw, lenient, {
        "delivered_at": "order_delivered_customer_date", "purchased_at": "order_purchase_timestamp"}).collect()}
    assert rep == {"delivered_at": False, "purchased_at": True}


def test_lenient_money_becomes_null(spark):
    import pytest
    from martlet.plans.staging import stage_order_items
    raw = raw_tables(spark, [orders_row("o1")], [item_row("o1", price="12.30"), item_row("o1", 2, price="")])[
        "order_items"]
    with pytest.raises(Exception):
        stage_order_items(raw).collect()
    got = sorted((r.order_item_id, r.price) for r in stage_order_items(raw, lenient=True).collect())
    assert str(got[0][1]) == "12.30" and got[1][1] is None
