"""Attributes kept as rows of (entity, attribute, value)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from haulmark.operators.skew import lookup_join

# Output column -> name of the attribute in the code table.
ASSET_ATTRIBUTES = {"make": "MAKE", "model": "MODEL NO"}


def attribute_columns(
    values: DataFrame,
    names: DataFrame,
    attributes: Mapping[str, str] = ASSET_ATTRIBUTES,
    entity: str = "operationalassetid",
) -> DataFrame:
    """Smallest value of each attribute per entity, for entities that have all of them.

    One pass over `values` (keyid, attributenameid, datavalue) whatever the number of
    attributes; `names` (tableid, tablename) is the shared code table.
    """
    wanted = names.where(F.col("tablename").isin(list(attributes.values()))).select(
        F.col("tableid").alias("attributenameid"), "tablename"
    )
    cells, present = [], F.lit(True)
    for column, name in attributes.items():
        is_it = F.col("tablename") == name
        cells.append(F.min(F.when(is_it, F.col("datavalue"))).alias(column))
        cells.append(F.max(F.when(is_it, F.lit(True))).alias(f"_has_{column}"))
        present = present & F.col(f"_has_{column}").isNotNull()
    return (
        lookup_join(values, wanted, "attributenameid")
        .groupBy(F.col("keyid").alias(entity))
        .agg(*cells)
        .where(present)
        .select(entity, *attributes)
    )
