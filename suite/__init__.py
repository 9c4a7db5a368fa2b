"""Queries over the benchmark tables, each running one public operator, with their SQL."""
