"""Generic DataFrame operators: dedup, ranking, joins, profiling, reports."""
