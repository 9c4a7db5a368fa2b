"""Ingestion tracker: one row per run with its row count and newest event time."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from haulmark.sources.runs import append_run


def ingestion_audit(
    df: DataFrame, source: str, time: str = "rovertimestamp", today: date | None = None
) -> DataFrame:
    """The tracker row of `df`, computed by a scan of its own."""
    run_date = F.current_date() if today is None else F.lit(today)
    return df.agg(
        F.lit(source).alias("source_name"),
        F.count(F.lit(1)).alias("ingested_row_count"),
        F.max(time).alias("rovertimestamp"),
        run_date.alias("ingestiontimestamp"),
    )


def last_ingested(tracker: DataFrame, source: str, default: Column) -> DataFrame:
    """One row, one column: the newest event time recorded for `source`, else `default`."""
    return tracker.where(F.col("source_name") == source).agg(
        F.coalesce(F.max("rovertimestamp"), default).alias("rovertimestamp")
    )


def write_with_audit(
    df: DataFrame,
    path: str,
    partition: str,
    tracker_path: str,
    source: str,
    time: str = "rovertimestamp",
    today: date | None = None,
) -> DataFrame:
    """Append `df` by `partition` and add its tracker row, as one unit and in one run of the plan.

    See `append_run` for what becomes of a run that is lost in between.
    """
    spark: SparkSession = df.sparkSession
    run = append_run(
        spark, path, lambda: df, partition, time=time, tracker=tracker_path, source=source, today=today
    )
    return run.tracker_row(spark)
