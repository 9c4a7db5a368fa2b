"""Composite operators: ingestion, flat file and maintenance reports."""
