"""One row per key by an ordering: the ``row_number() ... = 1`` pattern
written as an aggregate.

``min(struct(order..., payload...))`` keeps the first row per key, with
partial aggregation on the map side: each task reduces its rows to one per
key before the shuffle, so a key holding a large share of the rows costs no
more shuffle than any other. The window form sorts every row of a key in
one task.

Null placement follows Spark's defaults for ORDER BY: ascending puts NULLs
first, descending puts them last.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, NumericType, TimestampNTZType, TimestampType


def _descending(df: DataFrame, c: str) -> Column:
    t = df.schema[c].dataType
    if isinstance(t, TimestampType):
        return -F.unix_micros(F.col(c))
    if isinstance(t, TimestampNTZType):
        return -F.unix_micros(F.col(c).cast("timestamp"))
    if isinstance(t, DateType):
        return -F.unix_date(F.col(c))
    if isinstance(t, NumericType):
        return -F.col(c)
    raise TypeError(f"descending order on {t.simpleString()} column {c!r} is not supported")


def first_per_key(df: DataFrame, keys: list[str], order: list[tuple[str, bool]],
                  cols: list[str]) -> DataFrame:
    """For each key, the ``cols`` of the first row when sorted by ``order``
    (list of (column, ascending)). Returns keys + cols."""
    fields = []
    for i, (c, asc) in enumerate(order):
        if asc:
            fields += [F.col(c).isNotNull().alias(f"_n{i}"), F.col(c).alias(f"_o{i}")]
        else:
            fields += [F.col(c).isNull().alias(f"_n{i}"), _descending(df, c).alias(f"_o{i}")]
    payload = [F.col(c).alias(f"_p{j}") for j, c in enumerate(cols)]
    best = F.min(F.struct(*fields, *payload)).alias("_best")
    return (df.groupBy(*keys).agg(best)
            .select(*keys, *[F.col(f"_best._p{j}").alias(c) for j, c in enumerate(cols)]))


def latest_per_key(df: DataFrame, key: str, ts: str, tiebreak: str, cols: list[str]) -> DataFrame:
    """Latest row per key by ``ts``, ties broken by the smallest ``tiebreak``."""
    return first_per_key(df, [key], [(ts, False), (tiebreak, True)], cols)
