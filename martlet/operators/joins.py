"""Join-shaped checks: orphans, childless parents, grain-safe combination.

Missing-match tests are written as ``left_anti`` joins. The SQL idiom
``LEFT JOIN d ... WHERE d.k IS NULL`` stays an outer join plus a filter in
the optimised plan; the anti join emits nothing for matched rows and never
materialises the NULL-padded side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str | None = None) -> DataFrame:
    """Child rows whose key has no parent row. A NULL key is an orphan too
    (it resolves to no dimension row)."""
    pk = parent_key or child_key
    p = parent.select(F.col(pk).alias("_pk"))
    return child.join(p, child[child_key] == p["_pk"], "left_anti")


def key_counts(df: DataFrame, key: str, name: str = "_n") -> DataFrame:
    """Rows per key value (NULL is a key value too), aggregated on the map
    side first: a key holding most rows leaves each task as one row."""
    return df.groupBy(F.col(key).alias("_k")).agg(F.count(F.lit(1)).alias(name))


def orphan_count(child: DataFrame, parent: DataFrame, child_key: str,
                 parent_key: str | None = None, name: str = "orphans") -> DataFrame:
    """Number of child rows without a parent. The child is reduced to one
    row per key before the anti join, so the join shuffles keys, not rows."""
    pk = parent_key or child_key
    p = parent.select(F.col(pk).alias("_pk"))
    c = key_counts(child, child_key)
    return (c.join(p, c["_k"] == p["_pk"], "left_anti")
            .agg(F.coalesce(F.sum("_n"), F.lit(0)).alias(name)))


def match_counts(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Both directions of referential integrity from one full outer join of
    per-key row counts: (orphans = child rows whose key has no parent,
    childless_parents = parent rows whose key has no child)."""
    c = key_counts(child, child_key, "_c")
    p = key_counts(parent, parent_key, "_p").withColumnRenamed("_k", "_pk")
    j = c.join(p, c["_k"] == p["_pk"], "full")
    return j.agg(F.coalesce(F.sum(F.when(F.col("_pk").isNull(), F.col("_c"))), F.lit(0)).alias("orphans"),
                 F.coalesce(F.sum(F.when(F.col("_k").isNull() & F.col("_c").isNull(), F.col("_p"))),
                            F.lit(0)).alias("childless_parents"))


def childless(parent: DataFrame, child: DataFrame, key: str, child_key: str | None = None) -> DataFrame:
    """Parent rows with no child row (the reverse direction)."""
    ck = child_key or key
    c = child.select(F.col(ck).alias("_ck"))
    return parent.join(c, parent[key] == c["_ck"], "left_anti")


def combine_at_grain(left: DataFrame, right: DataFrame, key: str, left_aggs: list,
                     right_aggs: list, how: str = "inner") -> DataFrame:
    """Aggregate both sides to one row per key, then join. Joining two
    child tables of different grain directly multiplies their rows."""
    a = left.groupBy(key).agg(*left_aggs)
    b = right.groupBy(key).agg(*right_aggs)
    return a.join(b, key, how)


def fanout_rows(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Rows an equi-join would produce, computed from per-key counts without
    running the join: sum over keys of count_left * count_right. Returns
    (left_rows, right_rows, joined_rows, fanout_factor)."""
    a = key_counts(left, key, "_a")
    b = key_counts(right, key, "_b").withColumnRenamed("_k", "_kb")
    # one full outer join of per-key counts gives both sides' rows and the
    # joined rows (NULL keys never match, as in the equi-join)
    j = a.join(b, a["_k"] == b["_kb"], "full")
    return (j.agg(F.coalesce(F.sum("_a"), F.lit(0)).alias("left_rows"),
                  F.coalesce(F.sum("_b"), F.lit(0)).alias("right_rows"),
                  F.coalesce(F.sum(F.col("_a") * F.col("_b")), F.lit(0)).alias("joined_rows"))
            .withColumn("fanout_factor",
                        F.try_divide(F.col("joined_rows").cast("double"),
                                     F.col("left_rows").cast("double"))))



def sum_through(fact: DataFrame, dim: DataFrame, key: str, attrs: list[str], sums: dict[str, str],
                count_as: str | None = None) -> DataFrame:
    """Sum fact measures per dimension attributes through an inner equi-join
    on ``key``, with the fact summed per key first (Catalyst does not move
    an aggregate below a join). The join then sees one row per key instead
    of one per fact row, and the per-key partial sums are combined on the
    map side, so a hot key is reduced before the shuffle. Same result as
    joining rows and summing: a dimension key that occurs twice multiplies
    its per-key sum twice, so fan-out stays visible."""
    aggs = [F.sum(col).alias(out) for out, col in sums.items()]
    if count_as:
        aggs.append(F.count(F.lit(1)).alias(count_as))
    per_key = fact.groupBy(key).agg(*aggs)
    joined = per_key.join(dim.select(key, *attrs), key)
    outs = list(sums) + ([count_as] if count_as else [])
    return joined.groupBy(*attrs).agg(*[F.sum(o).alias(o) for o in outs])
