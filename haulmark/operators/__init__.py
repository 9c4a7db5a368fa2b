"""Operators on DataFrames: joins, deduplication and cumulative counts."""
