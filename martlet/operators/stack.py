"""Reports built from several one-row aggregates.

``stack_counts`` is the ``SELECT 'a', count(*) ... UNION ALL ...`` report:
every branch is an aggregate over its own input, all in one plan.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def row_count(df: DataFrame, label: str, label_col: str = "table_name", out: str = "rows") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(out)).select(F.lit(label).alias(label_col), out)


def stack_counts(items: list[tuple[str, DataFrame]], label_col: str = "table_name",
                 out: str = "rows") -> DataFrame:
    return union_all([row_count(df, label, label_col, out) for label, df in items])

