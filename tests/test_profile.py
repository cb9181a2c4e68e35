"""Profiling operators (Q1-Q20) on hand-made rows with the edge cases the
supplied tables lack: blanks, casing variants, NULL keys, duplicates."""

from pyspark.sql import functions as F

from martlet.operators import profile as prof


def test_key_and_duplicate_profiles(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1), ("b", 1), ("c", None)], "k string, s int")
    kp = {r.key: (r.rows, r.distinct_values, r.is_unique) for r in prof.key_profile(df, [["k"], ["k", "s"]]).collect()}
    assert kp == {"k": (5, 3, False), "k+s": (5, 4, False)}
    d = prof.duplicate_profile(df, ["k"]).first()
    assert (d.distinct_keys, d.duplicated_keys, d.rows_in_duplicates, d.max_multiplicity) == (3, 2, 4, 2)


def test_null_profile_counts_blanks_in_text_only(spark):
    df = spark.createDataFrame([("x", 1), ("  ", None), (None, 3), ("", 4)], "t string, n int")
    got = {r.column_name: (r.nulls, r.null_pct, r.blank_strings) for r in prof.null_profile(df).collect()}
    assert got == {"t": (1, 25.0, 2), "n": (1, 25.0, 0)}


def test_null_crosstab_and_co_missing(spark):
    df = spark.createDataFrame([("s1", None, None), ("s1", 1, None), ("s2", None, None)], "st string, a int, b int")
    ct = {(r.st, r.column_name): r.nulls for r in prof.null_crosstab(df, "st", ["a", "b"]).collect()}
    assert ct == {("s1", "a"): 1, ("s1", "b"): 2, ("s2", "a"): 1, ("s2", "b"): 1}
    cm = {(r.a_is_null, r.b_is_null): r.rows for r in prof.co_missing(df, ["a", "b"]).collect()}
    assert cm == {(True, True): 2, (False, True): 1}


def test_sequence_violations(spark):
    df = spark.createDataFrame([(1, 2), (3, 2), (None, 1), (5, 5)], "a int, b int")
    r = prof.sequence_violations(df, [("a", "b")]).first()
    assert (r.check_name, r.violations, r.applicable, r.violation_pct) == ("b < a", 1, 3, 100.0 / 3)


def test_childless_lookup_and_domain(spark):
    parent = spark.createDataFrame([(1, "x"), (2, "y"), (3, "y")], "id int, st string")
    child = spark.createDataFrame([(1,), (1,), (None,)], "pid int")
    got = {r.st: r.parents for r in prof.childless_by(parent, child.withColumnRenamed("pid", "id"), "id", "st").collect()}
    assert got == {"y": 2}
    lk = spark.createDataFrame([("a",)], "k string")
    vals = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "k string")
    assert {(r.k, r.rows) for r in prof.lookup_coverage(vals, lk, "k").collect()} == {("b", 2)}
    assert {r.k for r in prof.domain_coverage(vals, lk, "k").collect()} == {"b"}


def test_text_normalisation_and_numeric_sanity(spark):
    df = spark.createDataFrame([("Rio",), ("rio ",), ("sao",), (None,)], "c string")
    r = prof.text_normalisation(df, ["c"]).first()
    assert (r.distinct_values, r.distinct_normalised, r.variants_merged) == (3, 2, 1)
    nums = spark.createDataFrame([(0.0,), (-1.5,), (2.0,)], "v double")
    s = prof.numeric_sanity(nums, ["v"]).first()
    assert (s.le_zero, s.lt_zero, s.eq_zero, s.min_value, s.max_value) == (2, 1, 1, -1.5, 2.0)


def test_frequency_excludes_placeholder(spark):
    df = spark.createDataFrame([("card",), ("card",), ("boleto",), ("not_defined",)], "t string")
    got = {r.t: (r.rows, r.pct) for r in prof.frequency(df, "t", exclude=("not_defined",)).collect()}
    assert got == {"card": (2, 200.0 / 3), "boleto": (1, 100.0 / 3)}


def test_collapse_median_and_mode_with_tie(spark):
    rows = [("p", 1.0, "b"), ("p", 3.0, "a"), ("p", 2.0, "b"), ("p", 99999.0, "z"), ("q", 5.0, "y"), ("q", 6.0, "x")]
    df = spark.createDataFrame(rows, "k string, lat double, city string")
    got = {r.k: (r.median_lat, r.mode_city) for r in
           prof.collapse(df, "k", ["lat"], ["city"], ("lat", 0.0, 9000.0)).collect()}
    assert got == {"p": (2.0, "b"), "q": (5.5, "x")}


def test_fanout_and_reconcile(spark):
    a = spark.createDataFrame([(1, 10), (1, 20), (2, 5)], "k int, v int")
    b = spark.createDataFrame([(1, 15), (1, 15), (1, 0), (3, 1)], "k int, v int")
    f = prof.fanout_estimate(a, b, "k").first()
    assert (f.left_rows, f.right_rows, f.joined_rows, f.fanout_factor) == (3, 4, 6, 2.0)
    r = prof.reconcile(a.withColumn("v", F.col("v").cast("decimal(10,2)")),
                       b.withColumn("v", F.col("v").cast("decimal(10,2)")), "k", "v", "v").first()
    assert (r.keys_compared, r.differ_gt_0_01, float(r.net_difference)) == (1, 0, 0.0)


def test_orphan_rows_and_counts(spark):
    from martlet.operators.joins import match_counts, orphan_count, orphans
    child = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k int")
    parent = spark.createDataFrame([(1,), (3,)], "k int")
    assert {r.k for r in orphans(child, parent, "k").collect()} == {2, None}
    assert orphan_count(child, parent, "k").first().orphans == 2
    r = match_counts(child, "k", parent, "k").first()
    assert (r.orphans, r.childless_parents) == (2, 1)


def test_null_keys_and_unknown_types_stay(spark):
    from martlet.operators import profile
    from martlet.plans import metrics
    d = spark.createDataFrame([(None, 1.0, "x"), (None, 3.0, "x"), (1, 5.0, "y"), (1, 5.0, "Y ")], "k int, v double, t string")
    out = {r.k: (r.median_v, r.mode_t) for r in profile.collapse(d, "k", ["v"], ["t"]).collect()}
    assert out == {None: (2.0, "x"), 1: (5.0, "Y ")}
    norm = {r.column_name: (r.distinct_values, r.distinct_normalised, r.variants_merged)
            for r in profile.text_normalisation(d.withColumn("none", d.t.substr(1, 0)).replace("", None, ["none"]), ["t", "none"]).collect()}
    assert norm == {"t": (3, 2, 1), "none": (0, 0, 0)}
    amb = profile.lookup_ambiguity(d, "k", ["v", "t"]).first()
    assert (amb["keys"], amb.keys_multi_v, amb.keys_multi_t) == (2, 1, 1)
    p = spark.createDataFrame([(1, None, 2.0), (2, "not_defined", 1.0), (3, "a", 1.0)], "order_id int, payment_type string, payment_value double")
    assert {r.payment_type for r in metrics.payment_methods(p).collect()} == {None, "a"}
    assert {r.payment_type for r in profile.frequency(p, "payment_type", ("not_defined",)).collect()} == {None, "a"}
