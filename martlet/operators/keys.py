"""Which tables hold which key: one grouping for any number of relations.

The key columns of all tables are stacked, each row tagged with the column it
comes from, and grouped once by (domain, key) with one counter for each tag;
a domain is one kind of key ("product_id"). A key that is counted for a child
and not for its parent is an orphan, the reverse a childless parent, so both
directions of every relation are read off the counters. Every table is
scanned once, however many keys it has, and there is one shuffle for all
relations: of one row per key and task, since counters are reduced on the map
side (a key that a third of all rows hold leaves each task as one row). The
counters are fixed-width numbers, so this is a hash aggregate.

A NULL key is a group of its own that matches nothing.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DecimalType, DoubleType, FloatType

from .stack import union_all


@dataclass(frozen=True)
class Tag:
    """A key column (or expression) of a table. measure: a number column summed per key."""

    name: str
    frame: DataFrame
    key: Column
    domain: str
    measure: str | None = None


def _wide(kinds: list[DataType]) -> str:
    """One number type for all measures; sums of decimals stay exact."""
    if any(isinstance(k, (DoubleType, FloatType)) for k in kinds):
        return "double"
    scales = [k.scale for k in kinds if isinstance(k, DecimalType)]
    return f"decimal(38,{max(scales)})" if scales else "bigint"


def key_usage(tags: list[Tag]) -> DataFrame:
    """(domain, key, n_<tag> rows of each tag, m_<tag> sum of its measure)."""
    frames: list[tuple[DataFrame, list[int]]] = []
    for i, t in enumerate(tags):
        for df, own in frames:
            if df is t.frame:
                own.append(i)
                break
        else:
            frames.append((t.frame, [i]))
    kind = _wide([f.dataType for t in tags if t.measure for f in t.frame.schema if f.name == t.measure])
    stacked = []
    for df, own in frames:
        structs = []
        for i in own:
            value = F.col(tags[i].measure) if tags[i].measure else F.lit(None)
            structs.append(F.struct(F.lit(tags[i].domain).alias("domain"), tags[i].key.cast("string").alias("key"), F.lit(i).alias("tag"),
                                    value.cast(kind).alias("measure")))
        stacked.append(df.select(F.inline(F.array(*structs))))
    aggs = []
    for i, t in enumerate(tags):
        aggs.append(F.count_if(F.col("tag") == i).alias(f"n_{t.name}"))
        if t.measure:
            aggs.append(F.sum(F.when(F.col("tag") == i, F.col("measure"))).alias(f"m_{t.name}"))
    return union_all(stacked).groupBy("domain", "key").agg(*aggs)


def unmatched(rows: str, other: str, domain: str) -> Column:
    """Aggregate over ``key_usage``: rows of one tag whose key the other tag lacks."""
    lost = (F.col("domain") == domain) & (F.col("key").isNull() | (F.col(f"n_{other}") == 0))
    return F.coalesce(F.sum(F.when(lost, F.col(f"n_{rows}"))), F.lit(0))


def relation_counts(relations: list[tuple[str, DataFrame, str, DataFrame, str]]) -> DataFrame:
    """(relation, orphans, childless_parents) of each (name, child, child key,
    parent, parent key): one grouping for all of them."""
    tags: list[Tag] = []
    seen: list[tuple[DataFrame, str, str]] = []  # (table, column, domain) of each tag
    parents: list[tuple[DataFrame, str]] = []  # of each domain

    def tag(df: DataFrame, column: str, domain: str) -> str:
        for i, (f, c, d) in enumerate(seen):
            if f is df and (c, d) == (column, domain):
                return str(i)
        seen.append((df, column, domain))
        tags.append(Tag(str(len(tags)), df, F.col(column), domain))
        return tags[-1].name

    def domain_of(df: DataFrame, column: str) -> str:
        for i, (p, c) in enumerate(parents):
            if p is df and c == column:
                return str(i)
        parents.append((df, column))
        return str(len(parents) - 1)

    rows = []
    for name, child, ck, parent, pk in relations:
        d = domain_of(parent, pk)
        rows.append((name, d, tag(child, ck, d), tag(parent, pk, d)))
    aggs = []
    for i, (_, d, c, p) in enumerate(rows):
        aggs += [unmatched(c, p, d).alias(f"_o{i}"), unmatched(p, c, d).alias(f"_c{i}")]
    one = key_usage(tags).agg(*aggs)
    return one.select(F.inline(F.array(*[F.struct(F.lit(r[0]).alias("relation"), F.col(f"_o{i}").alias("orphans"),
                                                  F.col(f"_c{i}").alias("childless_parents")) for i, r in enumerate(rows)])))


def orphan_counts(child: DataFrame, parents: Iterable[tuple[str, str, DataFrame]]) -> DataFrame:
    """One row with, for each (output name, key, parent), the child rows
    whose key has no parent row: all keys in one grouping."""
    tags, aggs = [], []
    for i, (name, key, parent) in enumerate(parents):
        tags += [Tag(f"c{i}", child, F.col(key), key), Tag(f"p{i}", parent, F.col(key), key)]
        aggs.append(unmatched(f"c{i}", f"p{i}", key).alias(name))
    return key_usage(tags).agg(*aggs)
