"""Shares, running shares and top-N over already aggregated frames.

The total is a scalar subquery (one row, computed once and broadcast as a
value), not a window over all rows. The running share needs one global
order, so it is only applied to aggregated frames whose size is the number
of groups (states, categories), never to row-level data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def share_of_total(df: DataFrame, measure: str, out: str = "share_pct") -> DataFrame:
    """100 * measure / sum(measure) as double."""
    total = df.agg(F.sum(measure).cast("double")).scalar()
    return df.withColumn(out, F.try_divide(F.lit(100.0) * F.col(measure).cast("double"), total))


def cumulative_share(df: DataFrame, measure: str, tiebreak: str, out: str = "cumulative_share_pct",
                     rank_col: str = "rank") -> DataFrame:
    """Rank groups by measure (descending, then ``tiebreak``) and add the
    running share of the total."""
    total = df.agg(F.sum(measure).cast("double")).scalar()
    w = Window.orderBy(F.desc(measure), F.asc(tiebreak))
    running = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (df.withColumn(rank_col, F.row_number().over(w))
            .withColumn(out, F.try_divide(F.lit(100.0) * F.sum(measure).over(running).cast("double"),
                                          total)))


def top_n(df: DataFrame, measure: str, n: int, tiebreak: str) -> DataFrame:
    """The n groups with the largest measure (ties by ``tiebreak``): a
    distributed top-k (each task keeps n rows), not a full sort."""
    return df.orderBy(F.desc(measure), F.asc(tiebreak)).limit(n)
