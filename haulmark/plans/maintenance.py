"""Maintenance reports.

The large tables are work orders and meter readings. Everything that depends on the asset
alone (names, sort keys, counts, margins) is brought together on asset level first, so a
report joins its large table once. Sums and counts are taken per task before any shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from haulmark.functions.text import (
    EXCLUDED_NAME_PARTS,
    EXCLUDED_SORT_KEYS,
    MAKE_SPELLINGS,
    excludes_all,
    make_model_key,
    normalize_make,
    not_null_text,
    strip,
)
from haulmark.functions.timeops import days_between, safe_rate
from haulmark.operators.attributes import ASSET_ATTRIBUTES, attribute_columns
from haulmark.operators.latest import argmax_with_ties
from haulmark.operators.skew import dealt_join, heavy_among, lookup_join, repeated, split_join

ASSET = "operationalassetid"

# Work categories, labels, meter of the usage readings, and the margin in units of it.
FAILURE, MAINTENANCE = "Failure", "Maintenance"
FAILED, COMPLETED, UNLABELLED = "Failure", "PM Completed", ""
USAGE_METER = "Hour Meter"
USAGE_MARGIN = 350

# Work types counted as failures by make and model.
COUNTED_WORK_TYPES = ("FAIL", "FAILold", "SCH", "SCHold", "TIRES")

# Fixed value: estimates and margins from this many days on are left out by the cleanup.
LONGEST_INTERVAL = 800

# A margin of more days, over 2,700 years, has no end, which the calendar could not write.
LATEST_MARGIN = 1e6

# Days that stand for the end of a margin that is missing, or too far off.
NEVER_MET, NO_END = -(2**31), 2**31 - 1


def with_sort_key(asset: DataFrame, codes: DataFrame) -> DataFrame:
    """Assets with the name, value and description of their sort key."""
    keys = codes.select(
        F.col("tableid").alias("sortkeyid"),
        F.col("tablename").alias("sortkeyname"),
        "tablevalue",
        F.col("tabledescription").alias("sortkeydescription"),
    )
    return dealt_join(asset, keys, "sortkeyid")


def with_view(asset: DataFrame, view: DataFrame) -> DataFrame:
    """Assets with the name of their view."""
    names = view.select("operationalviewid", F.col("name").alias("operationalviewname"))
    return dealt_join(asset, names, "operationalviewid")


def qualifying(
    assets: DataFrame,
    sort_keys: Sequence[str] = EXCLUDED_SORT_KEYS,
    name_parts: Sequence[str] = EXCLUDED_NAME_PARTS,
) -> DataFrame:
    """Assets whose sort key and name are not excluded."""
    return assets.where(
        ~F.col("sortkeyname").isin(list(sort_keys))
        & excludes_all("operationalassetname", name_parts)
    )


def typed_orders(workorder: DataFrame, worktype: DataFrame, type_key: str) -> DataFrame:
    """Work orders with the name and category of their work type; as they are, if they have these."""
    if {"worktypename", "worktypecategory"} <= set(workorder.columns):
        return workorder
    types = worktype.select(
        F.col("worktypeid").alias(type_key),
        F.col("name").alias("worktypename"),
        F.col("category").alias("worktypecategory"),
    )
    return lookup_join(workorder, types, type_key)


def asset_usage(
    meter: DataFrame,
    assets: DataFrame,
    value: str | None,
    by: Sequence[str],
    when: str | None = None,
    whole_numbers: bool = False,
) -> DataFrame:
    """Usage per asset and `by`: sum of the value, first and last reading, any meter description.

    `value` names a column of `meter`; None takes the value of the asset's sort key for every
    reading. Text that is not a number counts as missing, and `whole_numbers` cuts fractions
    off each reading. Readings are summed per asset before the assets are joined.
    """

    def number(name: str) -> Column:
        amount = F.col(name).try_cast("double")
        return amount.try_cast("bigint") if whole_numbers else amount

    measures = [F.count(F.lit(1)).alias("_readings")]
    if value is not None:
        measures.append(F.sum(number(value)).alias("_sum"))
    if when is not None:
        measures += [F.min(when).alias("_first"), F.max(when).alias("_last")]
    if "meterdescription" in meter.columns and "meterdescription" not in by:
        measures.append(F.max("meterdescription").alias("_description"))
    meter_keys = [name for name in by if name in meter.columns]
    asset_keys = [name for name in by if name not in meter.columns]
    sums = meter.groupBy(ASSET, *meter_keys).agg(*measures)
    joined = sums.join(assets.select(ASSET, "tablevalue", *asset_keys), ASSET)
    usage = (
        F.col("_sum")
        if value is not None
        else F.col("_readings") * number("tablevalue")
    )
    totals = [F.sum(usage).alias("usage")]
    if when is not None:
        totals += [F.min("_first").alias("mindate"), F.max("_last").alias("maxdate")]
    if "_description" in joined.columns:
        totals.append(F.max("_description").alias("meterdescription"))
    return joined.groupBy(ASSET, *by).agg(*totals)


def pm_margin(
    meter: DataFrame,
    asset: DataFrame,
    codes: DataFrame,
    view: DataFrame,
    task: DataFrame,
    *,
    value: str | None = None,
    usage_meter: str = USAGE_METER,
    usage_margin: int = USAGE_MARGIN,
    cleanup: bool = False,
) -> DataFrame:
    """Per asset and top-level task: days of recorded use, maintenance interval and margin in days.

    `cleanup` leaves out readings without a usable value and intervals of zero or very many days.
    """
    assets = with_view(with_sort_key(asset, codes), view)
    readings = meter.where(F.col("meterdescription") == usage_meter)
    usage = asset_usage(readings, assets, value, by=(), when="updatetime", whole_numbers=True)
    frequency = argmax_with_ties(task, ASSET, "tasksynclevel").select(ASSET, "frequency")
    days = F.col("daterange")
    heavy = heavy_among(task, ASSET, task)
    margins = (
        split_join(frequency, usage, ASSET, heavy)
        .withColumnRenamed("usage", "value")
        .withColumn("daterange", days_between("mindate", "maxdate"))
        .withColumn("estimated", F.round(safe_rate(days * F.col("frequency"), F.col("value")), 0))
        .withColumn("pm_margin", F.lit(usage_margin))
        .withColumn(
            "pm_margin_days", F.round(safe_rate(days * F.col("pm_margin"), F.col("value")), 0)
        )
        .select(
            ASSET, "value", "mindate", "maxdate", "daterange", "frequency", "estimated",
            "pm_margin", "pm_margin_days",
        )
    )
    if cleanup:
        margins = margins.where(
            (F.col("value") > 1)
            & (F.col("estimated") < LONGEST_INTERVAL)
            & (F.col("pm_margin_days") < LONGEST_INTERVAL)
            & (F.col("estimated") != 0)
            & (F.col("pm_margin_days") != 0)
        )
    return margins


def maintenance_timeline(
    asset: DataFrame,
    codes: DataFrame,
    view: DataFrame,
    worktype: DataFrame,
    workorder: DataFrame,
    margins: DataFrame | None = None,
    *,
    type_key: str = "worktypeid",
    sort_keys: Sequence[str] = EXCLUDED_SORT_KEYS,
    name_parts: Sequence[str] = EXCLUDED_NAME_PARTS,
) -> DataFrame:
    """One row per failure raised and maintenance finished, with the failures of the asset's name.

    With `margins` (`pm_margin`) the final report: labelled rows of assets that have one, one
    row per margin. Without, the full listing, where an order lacking its date has no label.
    """
    names = _asset_names(asset, codes, view, sort_keys, name_parts)
    failed = F.col("worktypecategory") == FAILURE
    at = F.when(failed, F.col("raisedate")).otherwise(F.col("finishdate"))
    label = (
        F.when(F.col("all").isNull(), UNLABELLED).when(failed, FAILED).otherwise(COMPLETED)
    )
    orders = (
        typed_orders(workorder, worktype, type_key)
        .where(F.col("worktypecategory").isin(FAILURE, MAINTENANCE))
        .withColumn("all", at)
        .withColumn("type", label)
        .select(ASSET, "all", "type")
    )

    failures = orders.where(F.col("type") == FAILED).groupBy(ASSET).agg(
        F.count(F.lit(1)).alias("_failures")
    )
    per_name = (
        names.where(F.col("sortkeyname").isNotNull())
        .join(failures, ASSET)
        .groupBy("operationalassetname")
        .agg(F.sum(F.col("_failures") * F.col("_rows")).cast("int").alias("_no_failures"))
    )
    # An asset with an excluded sort key keeps its rows and loses its names.
    assets = repeated(dealt_join(names, per_name, "operationalassetname", "left"), "_rows")
    assets = assets.withColumn("no_failures", F.coalesce(F.col("_no_failures"), F.lit(0)))
    if margins is not None:
        orders = orders.where(F.col("type") != UNLABELLED)
    heavy_asset = heavy_among(orders, ASSET, workorder)

    columns = [
        ASSET, "operationalassetname", "operationalviewname", "sortkeyname", "all", "type",
        "no_failures",
    ]
    if margins is None:
        return split_join(orders, assets, ASSET, heavy_asset).select(*columns)
    assets = assets.join(margins.select(ASSET), ASSET)
    return split_join(orders, assets, ASSET, heavy_asset).select(
        *columns, F.lit(None).cast("boolean").alias("done")
    )


def _asset_names(
    asset: DataFrame,
    codes: DataFrame,
    view: DataFrame,
    sort_keys: Sequence[str],
    name_parts: Sequence[str],
) -> DataFrame:
    """Per asset with a view and sort key: its rows, and its names if the sort key is not excluded.

    The lookup tables are taken to one row per key first, so the assets are read and joined once.
    """
    kept = F.col("tablename").isNotNull() & ~F.col("tablename").isin(list(sort_keys))
    keys = codes.groupBy(F.col("tableid").alias("sortkeyid")).agg(
        F.max(F.when(kept, F.col("tablename"))).alias("_sortkey"), F.lit(True).alias("_keyed")
    )
    views = view.groupBy("operationalviewid").agg(
        F.max("name").alias("_view"), F.count(F.lit(1)).alias("_views")
    )
    rows = asset.select(ASSET, "operationalassetname", "sortkeyid", "operationalviewid")
    rows = dealt_join(rows, keys, "sortkeyid", "left")
    rows = dealt_join(rows, views, "operationalviewid", "left")
    named = F.coalesce(excludes_all("operationalassetname", name_parts), F.lit(False))
    viewed = named & F.col("_views").isNotNull()
    found = rows.groupBy(ASSET).agg(
        F.sum(F.when(viewed, F.col("_views"))).alias("_rows"),
        F.max("_keyed").alias("_keyed"),
        F.max(F.when(named, F.col("_sortkey"))).alias("sortkeyname"),
        F.max(F.when(viewed, F.col("operationalassetname"))).alias("_name"),
        F.max(F.when(viewed, F.col("_view"))).alias("_view"),
    )
    known = F.col("sortkeyname").isNotNull()
    return found.where(F.col("_rows").isNotNull() & F.col("_keyed").isNotNull()).select(
        ASSET, "_rows", "sortkeyname",
        F.when(known, F.col("_name")).alias("operationalassetname"),
        F.when(known, F.col("_view")).alias("operationalviewname"),
    )


def pm_schedule(margins: DataFrame) -> DataFrame:
    """Due dates of each row of `pm_margin`: every `estimated` days from first to last reading.

    An interval longer than the range gives the first date only.
    """
    whole = F.date_diff("maxdate", "mindate") + 1
    step = F.make_interval(days=F.least(F.col("estimated"), whole.cast("double")).cast("int"))
    due = F.sequence(F.col("mindate").cast("date"), F.col("maxdate").cast("date"), step)
    return margins.where(F.col("estimated") >= 1).withColumn("due", F.explode(due))


def _matched_windows(events: Column) -> Column:
    """Windows (until, due, scheduled, left) of one asset after its completions are dealt out.

    `events` are its due dates (kind 0, with `until`) and completions (kind 1) in order of day and kind. A
    completion goes to the open windows in order of their ends. This serves the same windows as taking
    these in order and giving each the earliest completion left. Only open windows are looked through, so
    an asset costs its events times the windows open at a time.
    """
    none = F.array().cast("array<struct<until:int,due:int,scheduled:bigint,left:bigint>>")

    def window(until: Column, due: Column, scheduled: Column, left: Column) -> Column:
        return F.struct(
            until.alias("until"), due.alias("due"), scheduled.alias("scheduled"), left.alias("left")
        )

    def step(state: Column, event: Column) -> Column:
        live = F.filter(state["open"], lambda w: w["until"] >= event["day"])
        gone = F.filter(state["open"], lambda w: w["until"] < event["day"])
        arrived = window(event["until"], event["day"], event["amount"], event["amount"])

        def deal(dealt: Column, w: Column) -> Column:
            taken = F.least(dealt["rest"], w["left"])
            after = F.array(window(w["until"], w["due"], w["scheduled"], w["left"] - taken))
            served = taken == w["left"]
            return F.struct(
                (dealt["rest"] - taken).alias("rest"),
                F.when(served, dealt["open"]).otherwise(F.concat(dealt["open"], after)).alias("open"),
                F.when(served, F.concat(dealt["closed"], after)).otherwise(dealt["closed"]).alias("closed"),
            )

        dealt = F.aggregate(
            live,
            F.struct(
                event["amount"].alias("rest"), none.alias("open"),
                F.concat(state["closed"], gone).alias("closed"),
            ),
            deal,
            lambda dealt: F.struct(dealt["open"].alias("open"), dealt["closed"].alias("closed")),
        )
        added = F.struct(
            F.sort_array(F.concat(live, F.array(arrived))).alias("open"),
            F.concat(state["closed"], gone).alias("closed"),
        )
        return F.when(event["kind"] == 0, added).otherwise(dealt)

    start = F.struct(none.alias("open"), none.alias("closed"))
    return F.aggregate(events, start, step, lambda state: F.concat(state["open"], state["closed"]))


def pm_compliance(
    schedule: DataFrame, completions: DataFrame, finished: str = "finishdate"
) -> DataFrame:
    """Scheduled dates with `done`: whether a completion of their own falls within the margin.

    Dates are served in order of the ends of their margins, each by the earliest completion not yet
    used. Copies of one due date and completions of one day are counted beforehand, so the list
    matched for one asset is bounded by the days of its calendar, however many rows it has.

    Without a margin a date is never met. A margin beyond `LATEST_MARGIN` days has no end. Both
    have no `until`.
    """
    days = F.col("pm_margin_days")
    until = (
        F.when(days.isNull(), NEVER_MET)
        .when(days > LATEST_MARGIN, NO_END)
        .otherwise(F.unix_date(F.date_add("due", days.try_cast("int"))))
    )
    wanted = schedule.groupBy(ASSET, F.unix_date("due").alias("day"), until.alias("until")).agg(
        F.count(F.lit(1)).alias("amount")
    )
    done = (
        completions.where(F.col(finished).isNotNull())
        .groupBy(ASSET, F.unix_date(F.col(finished).cast("date")).alias("day"))
        .agg(F.count(F.lit(1)).alias("amount"))
    )
    event = ("day", "kind", "until", "amount")
    events = wanted.withColumn("kind", F.lit(0)).select(ASSET, F.struct(*event).alias("_event"))
    others = done.withColumns({"kind": F.lit(1), "until": F.lit(0)})
    events = events.unionByName(others.select(ASSET, F.struct(*event).alias("_event")))
    matched = (
        events.groupBy(ASSET)
        .agg(F.sort_array(F.collect_list("_event")).alias("_events"))
        .where(F.exists("_events", lambda e: e["kind"] == 0) & F.col(ASSET).isNotNull())
        .select(ASSET, F.inline(_matched_windows(F.col("_events"))))
    )
    outcomes = F.array(
        F.struct(F.lit(True).alias("done"), (F.col("scheduled") - F.col("left")).alias("copies")),
        F.struct(F.lit(False).alias("done"), F.col("left").alias("copies")),
    )
    ends = F.when(~F.col("until").isin(NEVER_MET, NO_END), F.date_from_unix_date("until"))
    counted = matched.select(
        ASSET, F.date_from_unix_date("due").alias("due"), ends.alias("until"), F.inline(outcomes)
    )
    return repeated(counted, "copies").select(ASSET, "due", "until", "done")


def failures_by_make_model(
    asset: DataFrame,
    codes: DataFrame,
    attribute: DataFrame,
    worktype: DataFrame,
    workorder: DataFrame,
    *,
    type_key: str = "worktypeid",
    work_types: Sequence[str] = COUNTED_WORK_TYPES,
    sort_keys: Sequence[str] = EXCLUDED_SORT_KEYS,
    name_parts: Sequence[str] = EXCLUDED_NAME_PARTS,
    attributes: Mapping[str, str] = ASSET_ATTRIBUTES,
    spellings: Mapping[str, str] = MAKE_SPELLINGS,
) -> DataFrame:
    """Work orders of the counted types with four counts: assets and orders per make and per model.

    The model key is built from the corrected make. Orders are counted per asset once and
    the counts added up on asset level, so orders are shuffled by make or model nowhere.
    """
    make = normalize_make("make", spellings)
    assets = (
        qualifying(with_sort_key(asset, codes), sort_keys, name_parts)
        .join(attribute_columns(attribute, codes, attributes, ASSET), ASSET)
        .where(not_null_text("make"))
        .withColumn("make", make)
        .withColumn("model", F.lower(strip("model")))
        .withColumn("makenmod", make_model_key("make", "model"))
        .select(
            ASSET, "operationalassetname", "make", "model",
            F.col("installdate").alias("year"),
            F.col("sortkeydescription").alias("causeoffaultdescription"),
            "makenmod", "sortkeyname",
        )
    )
    orders = (
        typed_orders(workorder, worktype, type_key)
        .where(F.col("worktypename").isin(list(work_types)))
        .select(ASSET, "worktypename")
    )
    per_asset = orders.groupBy(ASSET).agg(F.count(F.lit(1)).alias("_orders"))
    counted = assets.join(per_asset, ASSET, "left")

    def counts(by: str, assets_name: str, orders_name: str) -> DataFrame:
        return counted.where(F.col(by).isNotNull()).groupBy(by).agg(
            F.count(ASSET).alias(assets_name),
            F.sum("_orders").alias(orders_name),
        )

    by_make = counts("make", "countofassetmakes", "countofmakesinworkorders")
    by_model = counts("makenmod", "countofassetmodels", "countofmodels")
    described = dealt_join(assets, by_make, "make", "left")
    described = dealt_join(described, by_model, "makenmod", "left")
    heavy_asset = heavy_among(orders, ASSET, workorder)
    return split_join(orders, described, ASSET, heavy_asset).select(
        ASSET, "operationalassetname", "make", "model", "year", "causeoffaultdescription",
        "makenmod", "worktypename", "countofassetmakes", "countofmakesinworkorders",
        "countofmodels", "countofassetmodels", "sortkeyname",
    )


def usage_vs_failures(
    asset: DataFrame,
    codes: DataFrame,
    view: DataFrame,
    worktype: DataFrame,
    workorder: DataFrame,
    meter: DataFrame,
    *,
    value: str | None = None,
    type_key: str = "worktypeid",
    cause_key: str | None = "workorderid",
    sort_keys: Sequence[str] = EXCLUDED_SORT_KEYS,
    name_parts: Sequence[str] = EXCLUDED_NAME_PARTS,
) -> DataFrame:
    """Per asset with usage and failures: both totals, meter, name, view and install date.

    `cause_key` is the order column that must name a code; None leaves the check out.
    """
    keyed = with_sort_key(asset, codes)
    viewed = with_view(asset.where(excludes_all("operationalassetname", name_parts)), view)
    orders = typed_orders(workorder, worktype, type_key).where(
        F.col("worktypecategory") == FAILURE
    )
    if cause_key is not None:
        orders = lookup_join(orders, codes.select(F.col("tableid").alias(cause_key)), cause_key)
    failures = (
        orders.groupBy(ASSET)
        .agg(F.count(F.lit(1)).alias("_failures"))
        .join(viewed, ASSET)
        .groupBy(ASSET)
        .agg(
            F.sum("_failures").alias("count"),
            F.max("operationalassetname").alias("name"),
            F.max("operationalviewname").alias("operationalviewname"),
        )
    )
    usage = asset_usage(meter, with_view(keyed, view), value, by=())
    installed = qualifying(keyed, sort_keys, name_parts).select(
        ASSET, F.col("installdate").alias("year")
    )
    return (
        installed.join(usage, ASSET)
        .join(failures, ASSET)
        .select(
            ASSET, "year", F.col("usage").alias("sum"), "meterdescription", "count", "name",
            "operationalviewname",
        )
    )


def fault_causes(
    asset: DataFrame,
    codes: DataFrame,
    view: DataFrame,
    worktype: DataFrame,
    workorder: DataFrame,
    *,
    type_key: str = "worktypeid",
    cause_key: str = "workorderid",
    sort_keys: Sequence[str] = EXCLUDED_SORT_KEYS,
    name_parts: Sequence[str] = EXCLUDED_NAME_PARTS,
    failure_name: str = "operationalviewname",
) -> DataFrame:
    """Failures with a cause, for every qualifying asset; an asset without any gets one row.

    The failures are evaluated once, also where an asset has very many of them.

    `failure_name` is the column the name exclusion applies to on the failure side.
    """
    keyed = with_sort_key(asset, codes)
    causes = codes.select(
        F.col("tableid").alias(cause_key),
        F.col("tabledescription").alias("causeoffaultdescription"),
    ).where(not_null_text("causeoffaultdescription"))
    # Only assets of the report get failures, so the two asset sides meet first.
    viewed = with_view(asset, view).where(excludes_all(failure_name, name_parts))
    assets = qualifying(keyed, sort_keys, name_parts).select(
        ASSET, F.col("operationalassetname").alias("name"),
        F.col("installdate").alias("year"), "sortkeyname",
    )
    orders = (
        typed_orders(workorder, worktype, type_key)
        .where(F.col("worktypecategory") == FAILURE)
        .select(ASSET, cause_key, "worktypecategory")
    )
    failures = lookup_join(orders, causes, cause_key)
    heavy_asset = heavy_among(failures, ASSET, workorder)
    # An asset's row brings its views along; one without a view meets no failure.
    views = viewed.groupBy(F.col(ASSET).alias("_asset")).agg(
        F.collect_list(F.struct("operationalviewname")).alias("_views")
    )
    located = assets.join(views, assets[ASSET] == F.col("_asset"), "left").withColumnRenamed(
        ASSET, "_reported"
    )
    failed = failures.withColumnsRenamed({ASSET: "_asset"}).withColumn("_failed", F.lit(True))
    found = split_join(failed, located, "_asset", heavy_asset, "right")
    return found.withColumn(
        "_view", F.explode_outer(F.when(F.col("_failed"), F.col("_views")))
    ).select(
        F.col("_reported").alias(ASSET), "name", "causeoffaultdescription",
        F.col("_view.operationalviewname").alias("operationalviewname"), "worktypecategory",
        "year", "sortkeyname",
    )


def usage_rate(
    asset: DataFrame,
    codes: DataFrame,
    view: DataFrame,
    meter: DataFrame,
    *,
    value: str | None = None,
    sort_keys: Sequence[str] = EXCLUDED_SORT_KEYS,
    name_parts: Sequence[str] = EXCLUDED_NAME_PARTS,
) -> DataFrame:
    """Per asset, meter and view: usage, first and last reading, days between and usage per day.

    Assets with an excluded sort key or name stay, without a sort key.
    """
    keyed = with_sort_key(asset, codes)
    details = ["operationalassetname", "operationalassetdescription", "operationalviewname"]
    readings = meter.select(*[name for name in meter.columns if name != "meterdescription"])
    usage = asset_usage(
        readings, with_view(keyed, view), value, by=["metername", *details], when="updatetime"
    )
    sort_key = qualifying(keyed, sort_keys, name_parts).select(ASSET, "sortkeyname")
    return (
        usage.join(sort_key, ASSET, "left")
        .withColumn("date_diff", days_between("mindate", "maxdate"))
        .select(
            ASSET, F.col("usage").alias("sumofvalue"), "maxdate", "mindate",
            "operationalviewname", "operationalassetdescription", "date_diff",
            safe_rate("usage", "date_diff").alias("ratio"), "metername",
            F.col("operationalassetname").alias("name"), "sortkeyname",
        )
    )
