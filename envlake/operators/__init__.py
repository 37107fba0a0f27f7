"""Operators on DataFrames: quality, joins, statistics, anomalies, star schema, merging and upserts."""
