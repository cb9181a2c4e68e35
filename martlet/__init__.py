"""martlet: marketplace order analytics on Spark DataFrames.

sources/    raw CSV load and export, layers and tables, supplied-table adapter
functions/  column expressions (money, scope window, rates, buckets, calendar)
operators/  generic operators (dedup, ranking and percentiles, joins, profiling)
plans/      the model: staging, dimensions, facts, extracts, metrics, checks
"""

__version__ = "0.1.0"
