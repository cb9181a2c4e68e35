"""Calendar attributes of a date column (the dim_date columns)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .expr import col


def calendar_columns(d: str | Column) -> list[Column]:
    """year, quarter, month number and name, yyyy-MM, day, day of week
    (1 = Sunday) and its name, weekend flag."""
    c = col(d)
    return [
        c.alias("date_key"),
        F.year(c).alias("year"),
        F.quarter(c).alias("quarter"),
        F.month(c).alias("month_number"),
        F.date_format(c, "MMMM").alias("month_name"),
        F.date_format(c, "yyyy-MM").alias("year_month"),
        F.dayofmonth(c).alias("day_of_month"),
        F.dayofweek(c).alias("day_of_week_number"),
        F.date_format(c, "EEEE").alias("day_of_week_name"),
        F.dayofweek(c).isin(1, 7).alias("is_weekend"),
    ]


def day_spine(lo: Column, hi: Column) -> Column:
    """One array of consecutive dates from lo to hi inclusive."""
    return F.sequence(lo, hi, F.expr("interval 1 day"))
