"""Newest rows, largest values and deduplication.

Everything here is a grouped aggregate, summed per task before its shuffle, and at most one
semi-join back to the rows. No window over a whole key is used, so a key holding a large
share of the rows never has to fit one task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F


def drop_tombstones(staging: DataFrame, operation: str = "dboperationtype") -> DataFrame:
    """Change-capture rows that are not deletions; a row without an operation is dropped too."""
    return staging.where(F.col(operation) != "D")


def snapshot_dimension(
    staging: DataFrame,
    attributes: Sequence[str],
    audit_time: str = "audtdateadded",
    not_null: Sequence[str] = (),
) -> DataFrame:
    """One row per distinct tuple of `attributes` with its newest audit time."""
    rows = staging.na.drop(subset=list(not_null)) if not_null else staging
    return rows.groupBy(*attributes).agg(F.max(audit_time).alias(audit_time))


def latest_by_maxima(df: DataFrame, key: str, maxima: Mapping[str, object]) -> DataFrame:
    """Distinct rows on which every column of `maxima` holds its largest value of the key.

    `maxima` maps column -> default for a missing value, or None to leave it missing. The
    default also replaces missing values in the result. A key whose maxima lie on different
    rows gives none, and ties give all their rows.
    """
    defaults = {
        name: F.lit(default).cast(df.schema[name].dataType)
        for name, default in maxima.items()
        if default is not None
    }

    def filled(name, value):
        return F.coalesce(value, defaults[name]) if name in defaults else value

    newest = df.groupBy(key).agg(
        *[filled(name, F.max(name)).alias(name) for name in maxima]
    )
    rows = df.withColumns({name: filled(name, F.col(name)) for name in defaults})
    return rows.join(newest, [key, *maxima], "left_semi").distinct()


def argmax_with_ties(df: DataFrame, key: str, column: str) -> DataFrame:
    """Rows holding the largest `column` of their key; ties are kept, null keys and values are not."""
    largest = df.groupBy(key).agg(F.max(column).alias(column))
    return df.join(largest, [key, column], "left_semi").select(*df.columns)


def any_value_per_key(df: DataFrame, key: str, *columns: str) -> DataFrame:
    """One value of each column per key: the largest, so that the choice does not vary."""
    return df.groupBy(key).agg(*[F.max(column).alias(column) for column in columns])
