"""Streaming form of the incremental ingestion."""
