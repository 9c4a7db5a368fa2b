"""Survival-analysis dataset: intervals between failures, with censoring.

The work orders are first summed to one row per asset and day, which bounds everything kept
per asset by the days of the calendar. Gaps and cumulative counts are windows over those
days; only the failures themselves are joined back to their day.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import DataFrame, Window, functions as F

from haulmark.functions.text import (
    EXCLUDED_SORT_KEYS,
    MAKE_SPELLINGS,
    excludes_all,
    normalize_make,
)
from haulmark.operators.attributes import ASSET_ATTRIBUTES, attribute_columns
from haulmark.operators.skew import heavy_hashes, may_hold_heavy, split_join
from haulmark.plans.maintenance import (
    ASSET,
    FAILURE,
    MAINTENANCE,
    typed_orders,
    with_sort_key,
    with_view,
)

# Fixed value: orders raised before this date are left out.
FIRST_RAISED = date(2016, 1, 1)


def survival_dataset(
    asset: DataFrame,
    worktype: DataFrame,
    workorder: DataFrame,
    *,
    type_key: str = "worktypeid",
    first_raised: date = FIRST_RAISED,
) -> DataFrame:
    """One row per failure, and one censored row per asset at the date of the last failure of all.

    `fail` is 1 or 0, `age_days` counts from the start of the install year,
    `sincefailure_days` from the asset's failure before (its first failure: from the first
    failure of all), and `cumulative_maintenance` the maintenance finished by that day. An
    asset maintained and never failed gets a censored row over the whole range; one without
    an install year gets none. `workorderid` must be unique, and the asset id in `asset`;
    dates are whole days.
    """
    orders = (
        typed_orders(workorder, worktype, type_key)
        .where(F.col("raisedate") >= F.lit(first_raised))
        .where(F.col("worktypecategory").isin(FAILURE, MAINTENANCE) & F.col(ASSET).isNotNull())
        .select(
            ASSET,
            "workorderid",
            F.col("raisedate").cast("date").alias("raised"),
            F.col("finishdate").cast("date").alias("finished"),
            (F.col("worktypecategory") == FAILURE).alias("failed"),
        )
    )
    failures = orders.where("failed").select(ASSET, "workorderid", F.col("raised").alias("day"))
    # One row per asset and day, shuffled once for both uses below; maintenance without a
    # finish date falls on a null day and is not counted.
    days = orders.groupBy(
        ASSET, F.when(F.col("failed"), F.col("raised")).otherwise(F.col("finished")).alias("day")
    ).agg(
        F.min(F.when(F.col("failed"), F.col("workorderid"))).alias("first_order"),
        F.count(F.when(~F.col("failed"), F.col("finished"))).alias("maintained"),
    )
    failed_day = F.when(F.col("first_order").isNotNull(), F.col("day"))
    bounds = (
        days.groupBy(ASSET)
        .agg(F.min(failed_day).alias("first"), F.max(failed_day).alias("last"))
        .join(asset.select(ASSET), ASSET, "left_semi")
        .agg(F.struct(F.min("first").alias("first"), F.max("last").alias("last")).alias("bounds"))
        .scalar()
    )
    first_day, last_day = bounds["first"], bounds["last"]
    order = Window.partitionBy(ASSET).orderBy("day")
    history = days.select(
        ASSET,
        "day",
        "first_order",
        F.coalesce(
            F.last(failed_day, ignorenulls=True).over(
                order.rowsBetween(Window.unboundedPreceding, -1)
            ),
            first_day,
        ).alias("earlier"),
        F.sum("maintained")
        .over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
        .alias("cumulative_maintenance"),
    )
    earlier = F.when(F.col("workorderid") == F.col("first_order"), F.col("earlier")).otherwise(
        F.col("day")
    )
    # Days meet their asset first, so the failures are joined once, a crowded day in parts.
    dated = history.where(F.col("first_order").isNotNull()).join(
        asset.select(ASSET, "operationalassetname", "installdate"), ASSET
    )
    crowded = {}
    if may_hold_heavy(workorder):
        [crowded] = heavy_hashes([failures.select(F.xxhash64(ASSET, "day"))])
    events = split_join(failures, dated, [ASSET, "day"], crowded).withColumns(
        {"fail": F.lit(1), "earlier": earlier}
    )

    # One row per asset: last failure, and the maintenance finished by the last day of all.
    totals = days.groupBy(ASSET).agg(
        F.max(failed_day).alias("last_failure"),
        F.sum(F.when(F.col("day") <= last_day, F.col("maintained")).otherwise(0)).alias(
            "cumulative_maintenance"
        ),
    )
    censored = totals.join(
        asset.select(ASSET, "operationalassetname", "installdate"), ASSET
    ).withColumns(
        {
            "fail": F.lit(0),
            "day": last_day,
            "earlier": F.coalesce(F.col("last_failure"), first_day),
        }
    )
    columns = [
        ASSET, "fail", "day", "earlier", "operationalassetname", "cumulative_maintenance",
        "installdate",
    ]
    start = F.make_date(F.year("installdate"), F.lit(1), F.lit(1))
    return (
        events.select(*columns)
        .unionByName(censored.select(*columns))
        .where(F.col("installdate").isNotNull())
        .select(
            ASSET,
            "fail",
            F.date_diff("day", start).alias("age_days"),
            F.date_diff("day", "earlier").alias("sincefailure_days"),
            "operationalassetname",
            "cumulative_maintenance",
        )
    )


def survival_by_make_site(
    survival: DataFrame,
    asset: DataFrame,
    codes: DataFrame,
    view: DataFrame,
    attribute: DataFrame,
    *,
    sort_keys: Sequence[str] = EXCLUDED_SORT_KEYS,
    name_parts: Sequence[str] | None = None,
    attributes: Mapping[str, str] = {"make": ASSET_ATTRIBUTES["make"]},
    spellings: Mapping[str, str] = MAKE_SPELLINGS,
) -> DataFrame:
    """`survival_dataset` with make, view and sort key instead of the asset id, without duplicates.

    `name_parts` excludes assets by name; None, as in the original report, keeps them all.
    """
    sites = (
        with_view(asset.select(ASSET, "operationalviewid"), view)
        .join(attribute_columns(attribute, codes, attributes, ASSET), ASSET)
        .groupBy(ASSET)
        .agg(
            F.max("operationalviewname").alias("operationalviewname"),
            F.max(normalize_make("make", spellings)).alias("make"),
        )
    )
    keyed = with_sort_key(asset, codes).where(~F.col("sortkeyname").isin(list(sort_keys)))
    if name_parts is not None:
        keyed = keyed.where(excludes_all("operationalassetname", name_parts))
    details = sites.join(keyed.select(ASSET, "sortkeyname"), ASSET)
    # Distinct rows of one asset are few, whatever the number of its failures.
    return survival.distinct().join(details, ASSET).drop(ASSET).distinct()
