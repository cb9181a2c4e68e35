"""Table profiling operators (Q1-Q20), generic over any DataFrame.

Every operator is a few aggregates; grouped counts use partial (map-side)
aggregation, so a value that covers a large share of the rows is reduced
before the shuffle. Wide results are turned into rows with ``stack``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..functions.expr import pct
from .dedup import first_per_key
from .joins import childless as _childless
from .joins import combine_at_grain, fanout_rows, key_counts
from .keys import relation_counts
from .sequence import percentiles_within
from .stack import union_all


def _stack(one_row: DataFrame, names: list[str], fields: list[list[str]], cols: list[str]) -> DataFrame:
    """Unpivot: ``names[i]`` with values ``fields[i]`` into columns ``cols``."""
    parts = ", ".join(
        ", ".join([f"'{n}'"] + [f"`{f}`" for f in fs]) for n, fs in zip(names, fields))
    return one_row.select(F.expr(f"stack({len(names)}, {parts}) as ({', '.join(cols)})"))


def key_profile(df: DataFrame, candidates: list[list[str]]) -> DataFrame:
    """Q1: rows and distinct values per candidate key (single or compound);
    is_unique when they match. A candidate whose columns another one covers
    is rolled up from that one's groups, which the plan shares."""
    widest = max(candidates, key=len)
    groups = df.groupBy(*widest).agg(F.count(F.lit(1)).alias("_n"))
    frames = []
    for keys in candidates:
        if keys == widest:
            distinct = groups
        elif set(keys) <= set(widest):
            distinct = groups.groupBy(*keys).agg(F.sum("_n").alias("_n"))
        else:
            distinct = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
        frames.append(distinct.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("rows"),
                                   F.count(F.lit(1)).alias("distinct_values"))
                      .select(F.lit("+".join(keys)).alias("key"), "rows", "distinct_values"))
    return union_all(frames).withColumn("is_unique", F.col("rows") == F.col("distinct_values"))


def duplicate_profile(df: DataFrame, keys: list[str]) -> DataFrame:
    """Q2: keys occurring more than once, rows they cover, max multiplicity."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(
        F.count(F.lit(1)).alias("distinct_keys"),
        F.count_if(F.col("n") > 1).alias("duplicated_keys"),
        F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).alias("rows_in_duplicates"),
        F.max("n").alias("max_multiplicity"))


def null_profile(df: DataFrame) -> DataFrame:
    """Q3: per column - NULLs, % NULL, and blank strings (trim = '') for
    text columns (0 for others). One pass over the table."""
    aggs = [F.count(F.lit(1)).alias("_rows")]
    names, fields = [], []
    for i, f in enumerate(df.schema.fields):
        aggs.append(F.count_if(F.col(f.name).isNull()).alias(f"_n{i}"))
        if isinstance(f.dataType, StringType):
            aggs.append(F.count_if(F.trim(F.col(f.name)) == "").alias(f"_b{i}"))
        else:
            aggs.append(F.lit(0).cast("bigint").alias(f"_b{i}"))
        names.append(f.name)
        fields.append([f"_n{i}", f"_b{i}"])
    one = df.agg(*aggs)
    parts = ", ".join(", ".join([f"'{n}'"] + [f"`{f}`" for f in fs]) for n, fs in zip(names, fields))
    long = one.select("_rows", F.expr(f"stack({len(names)}, {parts}) as (column_name, nulls, blank_strings)"))
    return long.select("column_name", "nulls", pct(F.col("nulls"), F.col("_rows")).alias("null_pct"),
                       "blank_strings")


def null_crosstab(df: DataFrame, by: str, cols: list[str]) -> DataFrame:
    """Q4: NULL counts of ``cols`` per value of ``by`` (long form)."""
    wide = df.groupBy(by).agg(*[F.count_if(F.col(c).isNull()).alias(f"_n{i}") for i, c in enumerate(cols)])
    parts = ", ".join(f"'{c}', `_n{i}`" for i, c in enumerate(cols))
    return wide.select(by, F.expr(f"stack({len(cols)}, {parts}) as (column_name, nulls)"))


def sequence_violations(df: DataFrame, pairs: list[tuple[str, str]]) -> DataFrame:
    """Q5: for each (earlier, later) pair, rows where later < earlier, rows
    where both are present, and the violation % of those."""
    aggs = []
    for i, (a, b) in enumerate(pairs):
        aggs += [F.count_if(F.col(b) < F.col(a)).alias(f"_v{i}"),
                 F.count_if(F.col(a).isNotNull() & F.col(b).isNotNull()).alias(f"_a{i}")]
    one = df.agg(*aggs)
    long = _stack(one, [f"{b} < {a}" for a, b in pairs],
                  [[f"_v{i}", f"_a{i}"] for i in range(len(pairs))],
                  ["check_name", "violations", "applicable"])
    return long.withColumn("violation_pct", pct(F.col("violations"), F.col("applicable")))


def status_without_value(df: DataFrame, status_col: str, status: str, cols: list[str]) -> DataFrame:
    """Q5 (second part): rows with a status whose lifecycle columns are NULL,
    e.g. delivered orders without a delivery time."""
    d = df.where(F.col(status_col) == status)
    one = d.agg(*[F.count_if(F.col(c).isNull()).alias(f"_n{i}") for i, c in enumerate(cols)])
    parts = ", ".join(f"'{c}', `_n{i}`" for i, c in enumerate(cols))
    return one.select(F.lit(status).alias(status_col),
                      F.expr(f"stack({len(cols)}, {parts}) as (column_name, rows_missing)"))


def volume_by_month(df: DataFrame, ts: str, months: DataFrame) -> DataFrame:
    """Q6: rows per month (yyyy-MM) over a month list, empty months as 0.
    ``months`` has a ``year_month`` column (e.g. from dim_date)."""
    per = df.groupBy(F.date_format(ts, "yyyy-MM").alias("year_month")).agg(F.count(F.lit(1)).alias("rows"))
    m = months.select("year_month").distinct()
    return m.join(per, "year_month", "left").select("year_month", F.coalesce("rows", F.lit(0)).alias("rows"))


def childless_by(parent: DataFrame, child: DataFrame, key: str, by: str) -> DataFrame:
    """Q7: parents without children, counted per ``by``."""
    return _childless(parent, child, key).groupBy(by).agg(F.count(F.lit(1)).alias("parents"))


def referential_integrity(relations: list[tuple[str, DataFrame, str, DataFrame, str]]) -> DataFrame:
    """Q8: per (name, child, child_key, parent, parent_key): child rows
    without a parent (orphans) and parent rows without a child. All
    relations share one grouping of the stacked keys (see ``operators.keys``)."""
    return relation_counts(relations)


def lookup_coverage(df: DataFrame, lookup: DataFrame, key: str, lookup_key: str | None = None) -> DataFrame:
    """Q9: non-NULL values of ``key`` missing from the lookup, and rows
    carrying them: one row per missing value."""
    lk = lookup_key or key
    counts = key_counts(df.where(F.col(key).isNotNull()), key, "rows")
    keys = lookup.select(F.col(lk).alias("_lk")).distinct()
    return counts.join(keys, counts["_k"] == keys["_lk"], "left_anti").withColumnRenamed("_k", key)


def frequency(df: DataFrame, col: str, exclude=()) -> DataFrame:
    """Q10: count and % of rows per value (share of the kept rows); NULL is a
    value like others, whatever is excluded."""
    d = df.where(~F.coalesce(F.col(col).isin(*exclude), F.lit(False))) if exclude else df
    counts = d.groupBy(col).agg(F.count(F.lit(1)).alias("rows"))
    total = counts.agg(F.sum("rows")).scalar()
    return counts.withColumn("pct", pct(F.col("rows"), total))


def text_normalisation(df: DataFrame, cols: list[str]) -> DataFrame:
    """Q11: distinct values before and after lower(trim()). All columns go
    through one scan: stacked to (column, value), made distinct, then grouped
    by the normal form, so the normal forms come from the distinct values."""
    stacked = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).alias("v")) for c in cols])).alias("s")).select("s.*")
    # a NULL per column keeps columns without values in the result
    names = df.sparkSession.createDataFrame([(c, None) for c in cols], "column_name string, v string")
    raw = stacked.unionByName(names).distinct()
    norm = raw.groupBy("column_name", F.lower(F.trim("v")).alias("norm")).agg(F.count("v").alias("n"))
    return (norm.groupBy("column_name").agg(F.sum("n").alias("distinct_values"),
                                            F.count("norm").alias("distinct_normalised"))
            .withColumn("variants_merged", F.col("distinct_values") - F.col("distinct_normalised")))


def numeric_sanity(df: DataFrame, cols: list[str]) -> DataFrame:
    """Q12: per numeric column - values <= 0, < 0, = 0, min and max (as double)."""
    aggs = []
    for i, c in enumerate(cols):
        v = F.col(c)
        aggs += [F.count_if(v <= 0).alias(f"_le{i}"), F.count_if(v < 0).alias(f"_lt{i}"),
                 F.count_if(v == 0).alias(f"_eq{i}"), F.min(v).cast("double").alias(f"_mn{i}"),
                 F.max(v).cast("double").alias(f"_mx{i}")]
    one = df.agg(*aggs)
    return _stack(one, cols, [[f"_le{i}", f"_lt{i}", f"_eq{i}", f"_mn{i}", f"_mx{i}"] for i in range(len(cols))],
                  ["column_name", "le_zero", "lt_zero", "eq_zero", "min_value", "max_value"])


def reconcile(a: DataFrame, b: DataFrame, key: str, a_value, b_value,
              tolerances=("0.01", "1.00")) -> DataFrame:
    """Q13: two sources of the same amount, each summed to one row per key
    first (never joined row to row), then compared on the keys both have:
    keys compared, keys differing by more than each tolerance, both totals
    and the net difference (b - a)."""
    j = combine_at_grain(a, b, key, [F.sum(a_value).alias("_a")], [F.sum(b_value).alias("_b")])
    diff = F.abs(F.col("_b") - F.col("_a"))
    aggs = [F.count(F.lit(1)).alias("keys_compared")]
    for t in tolerances:
        aggs.append(F.count_if(diff > F.lit(t).cast("decimal(10,2)"))
                    .alias("differ_gt_" + t.replace(".", "_")))
    aggs += [F.sum("_a").alias("total_a"), F.sum("_b").alias("total_b"),
             (F.sum("_b") - F.sum("_a")).alias("net_difference")]
    return j.agg(*aggs)


def missing_attribute_share(fact: DataFrame, dim: DataFrame, key: str, attr: str, measure: str) -> DataFrame:
    """Q14: rows and measure carried by fact rows whose dimension attribute
    is NULL, and their share of the total."""
    d = dim.select(key, F.col(attr).isNull().alias("_missing"))
    j = fact.join(d, key, "left")
    miss = F.coalesce(F.col("_missing"), F.lit(False))
    return j.agg(F.count_if(miss).alias("rows_missing"),
                 F.sum(F.when(miss, F.col(measure))).alias("measure_missing"),
                 F.sum(measure).alias("measure_total")) \
            .withColumn("share_pct", pct(F.col("measure_missing"), F.col("measure_total")))


def lookup_ambiguity(df: DataFrame, key: str, attrs: list[str]) -> DataFrame:
    """Q15: keys, and keys mapping to more than one value of each attribute.
    Two values differ when the smallest and the largest do, so no DISTINCT
    count (and no expansion of rows) is needed."""
    per = df.select(key, *attrs).distinct().groupBy(key).agg(
        *[(F.min(a) != F.max(a)).alias(f"_d{i}") for i, a in enumerate(attrs)])
    return per.agg(F.count(F.lit(1)).alias("keys"),
                   *[F.count_if(f"_d{i}").alias(f"keys_multi_{a}") for i, a in enumerate(attrs)])


def out_of_bounds(df: DataFrame, col: str, lo: float, hi: float) -> DataFrame:
    """Q15 (bounds): rows outside [lo, hi] (NULLs not counted)."""
    return df.agg(F.count(F.lit(1)).alias("rows"),
                  F.count_if(~F.col(col).between(lo, hi)).alias("rows_out_of_bounds"))


def mode_per_key(df: DataFrame, key: str, col: str, out: str) -> DataFrame:
    """Most frequent non-NULL value per key, smallest value on a tie.
    Counted per (key, value) with partial aggregation, then the winner
    chosen by an aggregate (no per-key value list)."""
    counts = df.where(F.col(col).isNotNull()).groupBy(key, col).agg(F.count(F.lit(1)).alias("_c"))
    return first_per_key(counts, [key], [("_c", False), (col, True)], [col]).withColumnRenamed(col, out)


def collapse(df: DataFrame, key: str, medians: list[str], modes: list[str],
             bounds: tuple[str, float, float] | None = None) -> DataFrame:
    """Q16: one row per key - exact median of each ``medians`` column and
    the modal value of each ``modes`` column, after dropping rows outside
    ``bounds`` = (column, lo, hi). A NULL key is a key."""
    d = df.where(F.col(bounds[0]).between(bounds[1], bounds[2])) if bounds else df
    out = d.select(key).distinct()

    def lookup(left: DataFrame, right: DataFrame) -> DataFrame:
        r = right.withColumnRenamed(key, "_k")
        return left.join(r, left[key].eqNullSafe(r["_k"]), "left").drop("_k")

    if medians:
        # all median columns ranked in one pass: stacked to (key, column,
        # value) rows, ranked per (key, column), pivoted back per key
        stacked = d.select(key, F.explode(F.array(*[
            F.struct(F.lit(c).alias("_col"), F.col(c).cast("double").alias("_val")) for c in medians]))
            .alias("_s")).select(key, "_s._col", "_s._val")
        med = percentiles_within(stacked, [key, "_col"], "_val", {"_median": 0.5})
        wide = med.groupBy(key).agg(*[F.max(F.when(F.col("_col") == c, F.col("_median"))).alias(f"median_{c}")
                                      for c in medians])
        out = lookup(out, wide)
    for c in modes:
        out = lookup(out, mode_per_key(d, key, c, f"mode_{c}"))
    return out


def fanout_estimate(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Q17: rows a join of a and b on key would produce."""
    return fanout_rows(a, b, key)


def domain_coverage(a: DataFrame, b: DataFrame, col: str, b_col: str | None = None) -> DataFrame:
    """Q19: distinct values of a.col absent from b (e.g. customer states
    without any seller)."""
    bc = b_col or col
    av = a.select(col).where(F.col(col).isNotNull()).distinct()
    bv = b.select(F.col(bc).alias("_v")).distinct()
    return av.join(bv, av[col] == bv["_v"], "left_anti")


def co_missing(df: DataFrame, cols: list[str]) -> DataFrame:
    """Q20: NULL patterns across ``cols`` and how many rows have each; columns
    always NULL together show up as patterns with both flags set."""
    flags = [F.col(c).isNull().alias(f"{c}_is_null") for c in cols]
    return df.select(*flags).groupBy(*[f"{c}_is_null" for c in cols]).agg(F.count(F.lit(1)).alias("rows"))

