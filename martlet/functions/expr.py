"""Column-expression helpers. All JVM-side built-ins; no UDFs."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(10,2)"


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money(c: str | Column) -> Column:
    """Cast to the money type. Decimal, not double, so totals are exact."""
    return col(c).cast(MONEY)


def try_money(c: str | Column) -> Column:
    """Like ``money`` but NULL instead of an error for malformed values."""
    return col(c).try_cast(MONEY)


def to_ts(c: str | Column) -> Column:
    """String or timestamp_ntz to timestamp (session zone, UTC)."""
    return col(c).cast("timestamp")


def try_to_ts(c: str | Column) -> Column:
    """Like ``to_ts`` but NULL instead of an error for unparseable strings."""
    return F.try_to_timestamp(col(c).cast("string"))


def in_window(c: str | Column, lo: dt.date, hi: dt.date) -> Column:
    """Half-open ``lo <= c < hi`` with typed literals; ``<= last day``
    would drop everything after midnight of that day."""
    # literals from text, parsed in the session time zone; a Python datetime
    # literal would be converted with the driver machine's local zone
    lo_ts = F.lit(f"{lo.isoformat()} 00:00:00").cast("timestamp")
    hi_ts = F.lit(f"{hi.isoformat()} 00:00:00").cast("timestamp")
    return (col(c) >= lo_ts) & (col(c) < hi_ts)


def count_true(flag: str | Column) -> Column:
    """Rows where a three-valued flag is TRUE (NULL counts as not true)."""
    return F.count_if(F.coalesce(col(flag), F.lit(False)))


def count_known(flag: str | Column) -> Column:
    """Rows where the flag is not NULL: the denominator of a rate."""
    return F.count(col(flag))


def pct(numerator: Column, denominator: Column) -> Column:
    """100 * n / d as double; NULL when d is 0 (no ANSI error)."""
    return F.try_divide(F.lit(100.0) * numerator.cast("double"), denominator.cast("double"))


def rate_pct(flag: str | Column, digits: int | None = 1) -> Column:
    """Share of TRUE among known values of a flag, in percent."""
    r = pct(count_true(flag), count_known(flag))
    return F.round(r, digits) if digits is not None else r


def bucketize(c: str | Column, edges: tuple[tuple[int, str], ...], open_label: str) -> Column:
    """Searched CASE ladder: first edge with ``c <= edge`` wins, else the open
    bucket. NULL input would fall into the open bucket, so callers filter
    NULLs first."""
    expr = None
    for edge, label in edges:
        expr = (F.when(col(c) <= edge, label) if expr is None
                else expr.when(col(c) <= edge, label))
    return expr.otherwise(open_label)


def fractional_days(end: str | Column, start: str | Column) -> Column:
    """Elapsed time in days with fractions (not day boundaries)."""
    return (F.unix_micros(col(end)) - F.unix_micros(col(start))).cast("double") / F.lit(86400e6)
