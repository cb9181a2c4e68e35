"""CSV raw load with quoted line breaks and doubled quotes; extract export."""

import os

import pytest

from pyspark.sql import functions as F

from martlet.sources.csv import (load_defects, load_raw_layer, multiline_difference, read_csv,
                                 read_extract_csv, write_extract_csv)
from martlet.sources.schemas import RAW_SCHEMAS


REVIEWS = ('review_id,order_id,review_score,review_comment_title,review_comment_message,'
           'review_creation_date,review_answer_timestamp\n'
           'r1,o1,5,,"hi\nthere ""x""",2018-01-18 00:00:00,2018-01-18 21:46:59\n'
           'r2,o2,1,title,plain,2018-03-10 00:00:00,2018-03-11 03:05:13\n')


def write(folder, name, text):
    with open(os.path.join(folder, name), "w") as f:
        f.write(text)


def test_multiline_field_is_one_row(spark, scratch):
    write(scratch, "order_reviews.csv", REVIEWS)
    df = read_csv(spark, f"{scratch}/order_reviews.csv", RAW_SCHEMAS["order_reviews"])
    rows = df.orderBy("review_id").collect()
    assert len(rows) == 2
    assert rows[0].review_comment_message == 'hi\nthere "x"'
    single = read_csv(spark, f"{scratch}/order_reviews.csv", RAW_SCHEMAS["order_reviews"], multiline=False, lenient=True)
    assert single.count() == 3


def test_multiline_difference_and_defects(spark, scratch):
    write(scratch, "order_reviews.csv", REVIEWS)
    diff = {r.parse: (r.rows, r.rows_with_required_nulls) for r in multiline_difference(
        spark, f"{scratch}/order_reviews.csv", RAW_SCHEMAS["order_reviews"], ["review_id", "order_id",
                                                                           "review_score"]).collect()}
    assert diff["multiline"] == (2, 0)
    assert diff["single_line"][0] == 3 and diff["single_line"][1] >= 1
    broken = read_csv(spark, f"{scratch}/order_reviews.csv", RAW_SCHEMAS["order_reviews"], multiline=False, lenient=True)
    d = {r.column_name: (r.excess_rows, r.nulls) for r in load_defects(broken, 2, ["order_id",
                                                                               "review_score"]).collect()}
    assert d["order_id"][0] == 1 and d["review_score"][1] >= 1


def test_raw_layer_to_parquet(spark, scratch):
    write(scratch, "order_reviews.csv", REVIEWS)
    out = os.path.join(scratch, "lake")
    raw = load_raw_layer(spark, scratch, out=out, tables=["order_reviews"])
    assert raw["order_reviews"].count() == 2
    assert os.path.isdir(os.path.join(out, "raw", "order_reviews"))


def test_extract_round_trip(spark, scratch):
    df = spark.createDataFrame([("a\nb", 1, "x,\"y\""), ("c", 2, None), ("  lead", 0, ""), ("trail  ", 0, " ")],
                               "label string, n int, t string")
    path = os.path.join(scratch, "extract")
    write_extract_csv(df, path)
    back = read_extract_csv(spark, path, df.schema)
    assert sorted(map(tuple, back.collect()), key=str) == sorted(map(tuple, df.collect()), key=str)
    assert back.agg(F.sum("n")).first()[0] == 3


@pytest.mark.parametrize("text", ["seller_state,seller_id,seller_zip_code_prefix,seller_city\nSP,s1,1,x\n",
                                  "seller_id,seller_zip_code_prefix,seller_city,seller_state\ns1,1\n"])
def test_wrong_files_fail(spark, scratch, text):
    write(scratch, "sellers.csv", text)
    with pytest.raises(Exception, match="(?i)header|malformed"):
        read_csv(spark, f"{scratch}/sellers.csv", RAW_SCHEMAS["sellers"]).collect()


def test_layers_and_materialise(spark, scratch):
    from martlet.sources.tables import create_schemas, register_views, save_table
    paths = create_schemas(spark, os.path.join(scratch, "lake"))
    assert set(paths) == {"raw", "staging", "marts"}
    assert {r.namespace for r in spark.sql("SHOW SCHEMAS").collect()} >= {"raw", "staging", "marts"}
    df = spark.createDataFrame([(2, "b"), (1, "a")], "k int, v string")
    back = save_table(df, paths["marts"] + "/t", ["k"])
    assert sorted(map(tuple, back.collect())) == [(1, "a"), (2, "b")]
    save_table(df.limit(1), paths["marts"] + "/t")
    assert spark.read.parquet(paths["marts"] + "/t").count() == 1
    register_views({"t": spark.read.parquet(paths["marts"] + "/t")}, prefix="v_")
    assert spark.sql("SELECT count(*) AS n FROM v_t").first().n == 1


def test_staging_views_are_queryable(spark):
    from martlet import registry
    m = registry.model(spark, "/root/testdata/sf0.001")
    names = m.staging_views(prefix="stg_")
    assert "stg_orders" in names and "stg_category_translation" in names
    n = spark.sql("SELECT count(*) AS n FROM stg_orders WHERE status = 'delivered'").first().n
    assert n == m.orders.where("status = 'delivered'").count()
