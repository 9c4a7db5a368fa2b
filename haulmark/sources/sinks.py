"""Parquet and CSV sinks, and registration of new partitions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from haulmark.sources.tables import table_name


def write_partitioned(
    df: DataFrame, path: str, partition: str, mode: str, rebalance: bool = True
) -> None:
    """Write Parquet by `partition`; mode is append, or overwrite to replace every partition.

    Rows are rebalanced by the partition column first: a small partition ends in one file,
    and a partition holding much of the data is cut into several tasks and files. Without
    `rebalance` this shuffle is saved where the rows come clustered or files may be many.
    """
    rows = df.hint("rebalance", partition) if rebalance else df
    rows.write.mode(mode).option("partitionOverwriteMode", "static").partitionBy(
        partition
    ).parquet(path)


def write_report(df: DataFrame, path: str) -> None:
    """Replace an unpartitioned report."""
    df.write.mode("overwrite").parquet(path)


def write_csv(df: DataFrame, path: str, separator: str = ",", one_file: bool = False) -> None:
    """Replace a CSV report; one file per task, each with a header.

    `one_file` is for small reports: one task writes all rows.
    """
    rows = df.repartition(1) if one_file else df
    rows.write.mode("overwrite").option("header", True).option("sep", separator).csv(path)


def write_rejects(rejects: DataFrame, path: str) -> int:
    """Append rejected rows with the time of the run, and return their number, counted while writing."""
    seen = Observation("rejects")
    rows = rejects.withColumn("rejected_at", F.current_timestamp())
    rows.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("append").parquet(path)
    return seen.get["rows"]


#: Folder name of the partition of rows without a value (fixed value).
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def add_partitions(
    spark: SparkSession, database: str, table: str, partition: str, values: Sequence[str]
) -> None:
    """Make the partitions with these `values` visible in the catalog table, and new files in them.

    The values come from the write itself, so the table's folder is not listed, however many
    partitions it has.
    """
    name = table_name(database, table)
    specs = [f"PARTITION ({partition} = {_literal(value)})" for value in values]
    for start in range(0, len(specs), 100):
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {' '.join(specs[start:start + 100])}")
    spark.catalog.refreshTable(name)


def _literal(value: str) -> str:
    if value == NULL_PARTITION:
        return "null"
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def register_partitions(
    spark: SparkSession, database: str, table: str, replaced: bool = False
) -> None:
    """Make partitions written by path visible in the catalog table.

    `replaced`: after an overwrite, partitions that are gone are dropped from it too.
    """
    action = "SYNC" if replaced else "ADD"
    spark.sql(f"MSCK REPAIR TABLE {table_name(database, table)} {action} PARTITIONS")
