"""Scans of catalog tables, Parquet directories and CSV files."""

from __future__ import annotations

import re
from collections.abc import Mapping
from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from haulmark.functions.timeops import parse_date

_IDENTIFIER = re.compile(r"[A-Za-z_][A-Za-z0-9_]*")
_DATE = re.compile(r"\d{4}-\d{2}-\d{2}")


def table_name(database: str, table: str) -> str:
    """`database.table`, refusing anything that is not a plain identifier."""
    for part in (database, table):
        if not _IDENTIFIER.fullmatch(part):
            raise ValueError(f"not a plain identifier: {part!r}")
    return f"{database}.{table}"


def renamed(df: DataFrame, columns: Mapping[str, str] | None) -> DataFrame:
    """Select `columns`, output name -> source column; all of them when None."""
    if columns is None:
        return df
    return df.select(*[F.col(source).alias(name) for name, source in columns.items()])


def catalog_table(
    spark: SparkSession, database: str, table: str, columns: Mapping[str, str] | None = None
) -> DataFrame:
    return renamed(spark.table(table_name(database, table)), columns)


def partition_dates(spark: SparkSession, database: str, table: str) -> list[date]:
    """Dates of the partitions that the catalog lists for a table partitioned by one date."""
    rows = spark.sql(f"SHOW PARTITIONS {table_name(database, table)}").collect()
    values = (row["partition"].split("=", 1)[1] for row in rows)
    return [date.fromisoformat(value) for value in values if _DATE.fullmatch(value)]


def parquet_table(
    spark: SparkSession, path: str, columns: Mapping[str, str] | None = None
) -> DataFrame:
    return renamed(spark.read.parquet(path), columns)


#: Column of the raw text of a CSV row that does not fit its schema.
REJECTED = "rejected_row"


def _csv(spark: SparkSession, path: str, schema: T.StructType, date_pattern: str) -> DataFrame:
    """Rows with `REJECTED`, null where every value fits. Dates are read as text and parsed."""
    as_text = T.StructType(
        [
            T.StructField(f.name, T.StringType() if f.dataType == T.DateType() else f.dataType)
            for f in schema
        ]
        + [T.StructField(REJECTED, T.StringType())]
    )
    dates = {f.name: parse_date(f.name, date_pattern) for f in schema if f.dataType == T.DateType()}
    rows = spark.read.csv(
        path, schema=as_text, header=True, mode="PERMISSIVE", columnNameOfCorruptRecord=REJECTED
    )
    return rows.withColumns(dates)


def csv_table(
    spark: SparkSession, path: str, schema: T.StructType, date_pattern: str = "M/d/yy"
) -> DataFrame:
    """CSV with a header. A bad date or number is null, not an error; see `checked_csv` to keep such rows apart."""
    return _csv(spark, path, schema, date_pattern).drop(REJECTED)


def checked_csv(
    spark: SparkSession, path: str, schema: T.StructType, date_pattern: str = "M/d/yy"
) -> tuple[DataFrame, DataFrame]:
    """The rows of a CSV that fit `schema`, and those that do not: file and raw text of each.

    A row is rejected for a number that is none, or for too few or too many values. A bad date
    alone is null, as in `csv_table`. Both frames read the whole rows, since Spark notices what is wrong in a
    column only when it reads it.
    """
    rows = _csv(spark, path, schema, date_pattern).withColumn("file", F.input_file_name())
    raw, read = F.col(REJECTED), F.concat_ws(",", *schema.names)
    # true for each kind of row, and reads every column
    bad = rows.where(raw.isNotNull() & (F.coalesce(raw, read) == raw)).select("file", REJECTED)
    return rows.where(raw.isNull() & (F.coalesce(raw, read) == read)).select(*schema.names), bad


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, in any store that Spark reads."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)
