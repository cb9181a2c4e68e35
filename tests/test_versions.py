"""Replacing tables by version, layers by name, rejects of a load."""

import os

import pytest
from pyspark.sql import functions as F

from martlet import registry
from martlet.sources import catalog, versions
from martlet.sources.csv import RAW_FILES, load_raw_layer, load_report, loaded_rows, rejects, stored_raw

SF = "/root/testdata/sf0.001"


def rows(df):
    return sorted(map(tuple, df.collect()))


def test_replace_reads_the_new_version_and_keeps_the_one_before(spark, scratch):
    t = f"{scratch}/t"
    df = spark.range(10).withColumn("v", F.col("id").cast("decimal(10,2)"))
    versions.replace(df.where("id < 4"), t, {"v": F.sum("v")})
    old = versions.read(spark, t)
    got = versions.replace(df, t, {"v": F.sum("v")}, sort_within=["id"])
    assert got.count() == 10 and versions.read(spark, t).count() == 10
    assert old.count() == 4                                    # a reader that began before
    v = versions.current(spark, t)
    assert v.number == 2 and v.metrics["rows"] == 10 and str(v.decimal("v")) == "45.00"
    versions.replace(df.where("id < 1"), t)
    assert [v.number for v in versions.versions(spark, t)] == [2, 3]
    assert len(os.listdir(f"{t}/_data")) == 2


def test_failed_replacement_leaves_the_old_version(spark, scratch):
    t = f"{scratch}/t"
    versions.replace(spark.range(5), t)
    bad = spark.range(100, numPartitions=4).select(F.expr("IF(id = 99, raise_error('lost'), id) AS id"))
    with pytest.raises(Exception, match="lost"):
        versions.replace(bad, t)
    assert versions.read(spark, t).count() == 5 and versions.current(spark, t).number == 1
    assert len(os.listdir(f"{t}/_data")) == 1


def test_cut_off_commit_does_not_count(spark, scratch):
    t = f"{scratch}/t"
    versions.replace(spark.range(5), t)
    with open(f"{t}/_versions/00000002", "w") as f:
        f.write('{"number": 2, "fol')
    assert versions.current(spark, t).number == 1
    versions.replace(spark.range(6), t)
    assert versions.current(spark, t).number == 3 and versions.read(spark, t).count() == 6


def test_two_writers_from_one_version_conflict(spark, scratch):
    t = f"{scratch}/t"
    versions.replace(spark.range(5), t)

    def slow(df, folder):  # another writer commits meanwhile
        versions.replace(spark.range(7), t)
        df.write.parquet(folder)

    with pytest.raises(versions.Conflict):
        versions.replace(spark.range(6), t, write=slow)
    assert versions.read(spark, t).count() == 7


def test_empty_and_partitioned_versions(spark, scratch):
    t = f"{scratch}/t"
    df = spark.range(100).select("id", (F.col("id") % 3).cast("int").alias("k"))
    assert rows(versions.replace(df, t, partition_by="k", sort_within=["id"])) == rows(df.select("id", "k"))
    assert versions.replace(df.limit(0), t).count() == 0
    assert versions.current(spark, t).metrics["rows"] == 0


def test_another_session_reads_the_layers_by_name(spark):
    m = registry.model(spark, SF)
    layers = catalog.publish(spark, m.lake, "t1_", False, m.params.translation_patches)
    other = spark.newSession()
    n = other.sql(f"SELECT count(*) AS n FROM {layers.table('staging', 'orders')} WHERE status = 'delivered'").first().n
    assert n == m.orders.where("status = 'delivered'").count()
    assert rows(other.table("t1_staging.category_translation")) == rows(m.category_translation)
    assert other.table("t1_marts.fct_orders").count() == m.fct_orders.count()
    views = {r.viewName for r in other.sql("SHOW VIEWS IN t1_staging").collect()}
    assert views == {"orders", "order_items", "order_payments", "order_reviews", "customers", "products", "sellers", "category_translation"}
    catalog.withdraw(spark, layers)
    assert not spark.catalog.databaseExists("t1_staging")
    catalog.attach(spark, m.lake, "t1_")     # from the folder alone
    assert other.table("t1_staging.orders").count() == m.orders.count()
    catalog.withdraw(spark, layers)


def test_name_follows_the_version(spark, scratch):
    versions.replace(spark.range(3), f"{scratch}/lake/marts/t")
    catalog.attach(spark, f"{scratch}/lake", "t2_")
    assert spark.table("t2_marts.t").count() == 3
    versions.replace(spark.range(4), f"{scratch}/lake/marts/t")
    catalog.attach(spark, f"{scratch}/lake", "t2_")
    assert spark.table("t2_marts.t").count() == 4
    versions.replace(spark.range(4).select(F.col("id").alias("other")), f"{scratch}/lake/marts/t")
    catalog.attach(spark, f"{scratch}/lake", "t2_")
    assert spark.table("t2_marts.t").columns == ["other"]
    catalog.withdraw(spark, catalog.Layers("t2_"))


ITEMS = """order_id,order_item_id,product_id,seller_id,shipping_limit_date,price,freight_value
o1,1,p1,s1,2017-05-03 00:00:00,10.00,1.00
o1,two,p1,s1,2017-05-03 00:00:00,10.00,1.00
o2,1,p1,s1,2017-05-03 00:00:00,ten,1.00
o3,1,p1,s1,soon,ten,1.00
o4,1,p1
o5,1,p1,s1,,,
"""


def test_quarantine_keeps_rejects_with_file_and_reason(spark, scratch):
    os.makedirs(f"{scratch}/in/order_items")
    for i in (1, 2):
        with open(f"{scratch}/in/order_items/{i}.csv", "w") as f:
            f.write(ITEMS)
    raw = load_raw_layer(spark, f"{scratch}/in", files=dict(RAW_FILES, order_items="order_items"), out=scratch,
                         tables=["order_items"], quarantine=True)
    assert sorted(r.order_id for r in raw["order_items"].collect()) == ["o1", "o1", "o5", "o5"]
    assert loaded_rows(spark, scratch, ["order_items"]) == {"order_items": 4}
    assert stored_raw(spark, scratch, "order_items").columns == raw["order_items"].columns
    found = rejects(spark, scratch, "order_items").where("file LIKE '%/1.csv'").collect()
    assert sorted((r.reasons, r.record[:3]) for r in found if r.reasons == ["malformed row"]) == [(["malformed row"], "o1,"), (["malformed row"], "o4,")]
    assert sorted(tuple(r.reasons) for r in found if r.reasons != ["malformed row"]) == [
        ("no money: price",), ("no timestamp: shipping_limit_date", "no money: price")]
    report = {(r.file[-5:], r.reason): r.rows for r in load_report(spark, scratch, ["order_items"]).collect()}
    assert report[("1.csv", None)] == 2 and report[("2.csv", "malformed row")] == 2 and report[("1.csv", "no money: price")] == 2
    assert sum(n for (f, r), n in report.items() if r is None) == 4


def test_clean_load_with_quarantine_has_no_rejects(spark, scratch):
    with open(f"{scratch}/sellers.csv", "w") as f:
        f.write("seller_id,seller_zip_code_prefix,seller_city,seller_state\ns1,01000,x,SP\n")
    raw = load_raw_layer(spark, scratch, out=f"{scratch}/lake", tables=["sellers"], quarantine=True)
    assert rows(raw["sellers"]) == [("s1", "01000", "x", "SP")]
    assert rejects(spark, f"{scratch}/lake", "sellers").count() == 0
