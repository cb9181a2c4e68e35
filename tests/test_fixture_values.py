"""The trial values published in FIXTURES.md, computed by the library (an
oracle independent of the DuckDB texts), and the validation report."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from martlet import registry
from martlet.operators import profile as prof
from martlet.plans import checks

# FIXTURES.md "Values from a throwaway trial", per scale.
TRIAL = {
    "/root/testdata/sf0.001": dict(items=2882, orders=710, revenue="153481926.95", freight="6073827.07",
                                   late=240, delivered=295, ties=292, handover_before=1112,
                                   delivered_no_date=101, no_items=27, payments=(1770, 1473),
                                   differ=(31, 17), net="92.50", geo_out=(24, 150)),
    "/root/testdata/sf0.01": dict(items=28208, orders=6910, revenue="1495120064.65", freight="59693424.17",
                                  late=2442, delivered=2889, ties=2993, handover_before=11237,
                                  delivered_no_date=1114, no_items=257, payments=(17692, 14743),
                                  differ=(318, 165), net="902.50", geo_out=(275, 1500)),
}


@pytest.mark.parametrize("sf", sorted(TRIAL))
def test_trial_values(spark, sf):
    t = TRIAL[sf]
    m = registry.model(spark, sf)
    assert m.fct_order_items.count() == t["items"]
    assert m.fct_orders.count() == t["orders"]
    tot = m.fct_order_items.agg(F.sum("revenue_net").alias("r"), F.sum("freight_cost").alias("f")).first()
    assert (str(tot.r), str(tot.f)) == (t["revenue"], t["freight"])
    lt = m.fct_orders.agg(F.count_if("is_late").alias("l"), F.count("is_late").alias("d")).first()
    assert (lt.l, lt.d) == (t["late"], t["delivered"])
    latest = m.order_reviews.groupBy("order_id").agg(F.max("created_at").alias("mx"))
    ties = (m.order_reviews.join(latest, "order_id").where(F.col("created_at") == F.col("mx"))
            .groupBy("order_id").count().where("count > 1").count())
    assert ties == t["ties"]
    assert m.orders.where(F.col("carrier_handover_at") < F.col("purchased_at")).count() == t["handover_before"]
    assert m.orders.where((F.col("status") == "delivered") & F.col("delivered_at").isNull()).count() \
        == t["delivered_no_date"]
    assert sum(r.parents for r in prof.childless_by(m.orders, m.order_items, "order_id", "status").collect()) \
        == t["no_items"]
    p = m.order_payments
    assert (p.count(), p.select("order_id").distinct().count()) == t["payments"]
    items = m.order_items.withColumn("amount", F.col("price") + F.col("freight_value"))
    r = prof.reconcile(items, p, "order_id", "amount", "payment_value").first()
    assert (r.differ_gt_0_01, r.differ_gt_1_00, str(r.net_difference)) == (*t["differ"], t["net"])
    geo = m.raw["geolocation"]
    ob = prof.out_of_bounds(geo, "geolocation_lat", 0.0, 9000.0).first()
    assert (ob.rows_out_of_bounds, ob.rows) == t["geo_out"]
    amb = prof.lookup_ambiguity(geo, "geolocation_zip_code_prefix", ["geolocation_city"]).first()
    assert amb.keys == 25 and amb.keys_multi_geolocation_city == 25


@pytest.mark.parametrize("sf", sorted(TRIAL))
def test_validation_report_passes(spark, sf):
    m = registry.model(spark, sf)
    report = {r.check: r.passed for r in checks.validation_report(m, dt.date(1996, 1, 1)).collect()}
    assert len(report) == 14 and all(report.values()), report
