"""The jobs: catalog tables in, partitioned Parquet and registered partitions out.

Each job takes the session, database names and output path, and calls the operators of the
other modules; nothing is computed here.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from haulmark.plans import maintenance, refresh, survival, telemetry
from haulmark.plans.incremental import HISTORY_START, incremental_delta, today_in
from haulmark.sources.runs import append_run, last_run
from haulmark.sources.sinks import (
    add_partitions,
    register_partitions,
    write_csv,
    write_partitioned,
    write_report,
)
from haulmark.sources.tables import catalog_table, partition_dates
from haulmark.sources.tracker import last_ingested

# Event time of each delta table. Tables watermarked on server time also
# leave out partitions dated after today when they look for the watermark.
DELTA_EVENT_TIME = {
    "latch": "rovertimestamp",
    "fuel": "rovertimestamp",
    "impact": "rovertimestamp",
    "position": "servertimestamp",
    "tire": "servertimestamp",
    "tiredetail": "servertimestamp",
}

# Fixed value: first partition date of the rebuilt flat file.
FLAT_FILE_START = date(2018, 8, 1)

# Table of the flat file, and its name in the tracker, unless the caller gives another.
FLAT_FILE = "flat_file"


# Columns of the typed work orders that the reports use.
ORDER_COLUMNS = (
    "workorderid", maintenance.ASSET, "worktypename", "worktypecategory", "raisedate", "finishdate"
)


def run_delta(
    spark: SparkSession, staging_db: str, target_db: str, table: str, path: str
) -> None:
    """Append the new rows of one delta table and register the partitions written.

    Runs of one table from the same watermark leave their rows once.
    """
    event_time = DELTA_EVENT_TIME[table]
    guard = today_in() if event_time == "servertimestamp" else None

    def fresh() -> DataFrame:
        target = _whole(spark, target_db, table, path)
        return incremental_delta(
            catalog_table(spark, staging_db, table),
            target,
            event_time=event_time,
            today=guard,
            listed=partition_dates(spark, target_db, table),
        )

    run = append_run(spark, path, fresh, "sourcesystemdate")
    add_partitions(spark, target_db, table, run.partition, run.values)


def _whole(spark: SparkSession, database: str, table: str, path: str) -> DataFrame:
    """The target with what the last run of its ledger wrote, which may not have come to registering it."""
    run = last_run(spark, path)
    if run is not None:
        add_partitions(spark, database, table, run.partition, run.values)
    return catalog_table(spark, database, table)


def run_refresh(
    spark: SparkSession, staging_db: str, target_db: str, table: str, path: str
) -> None:
    """Replace one dimension or latest-record table and register its partitions."""
    staging = catalog_table(spark, staging_db, table)
    if table == "roverdetails":
        rows, partition = refresh.rover_details(staging), "yrmon"
    elif table == "vehicledetails":
        rows, partition = refresh.vehicle_details(staging), "yrmon"
    else:
        rows, partition = refresh.dimension(staging, table), "sourcesystem"
    write_partitioned(rows, path, partition, "overwrite")
    register_partitions(spark, target_db, table, replaced=True)


def _flat_file_inputs(spark: SparkSession, database: str, positions: str, tires: bool):
    def table(name: str) -> DataFrame:
        return catalog_table(spark, database, name)

    lookbacks = telemetry.reading_lookbacks(
        table("latch"), table("fuel"), table("impact"), table("tireenh") if tires else None
    )
    return table(positions), table("latchtype"), table("vehicletype"), lookbacks


def run_flat_file(
    spark: SparkSession,
    database: str,
    path: str,
    default: date = HISTORY_START,
    table: str = FLAT_FILE,
) -> None:
    """Append the flat-file rows newer than the flat file itself, with tire readings."""

    def fresh() -> DataFrame:
        positions, latch_types, vehicle_types, lookbacks = _flat_file_inputs(
            spark, database, "positionenh", tires=True
        )
        target = _whole(spark, database, table, path)
        positions, lookbacks = telemetry.newer_than_target(positions, lookbacks, target, default)
        return telemetry.flat_file(positions, latch_types, vehicle_types, lookbacks)

    run = append_run(spark, path, fresh, "sourcesystemdate")
    add_partitions(spark, database, table, run.partition, run.values)


def run_tracked_flat_file(
    spark: SparkSession,
    database: str,
    path: str,
    tracker_path: str,
    default: date = date(2018, 8, 1),
    today: date | None = None,
    source: str = FLAT_FILE,
) -> DataFrame:
    """Append the flat-file rows newer than the tracker, and add the run to the tracker, as one unit."""

    def fresh() -> DataFrame:
        positions, latch_types, vehicle_types, lookbacks = _flat_file_inputs(
            spark, database, "positionenh", tires=False
        )
        start = F.lit(default).cast(positions.schema["rovertimestamp"].dataType)
        watermark = last_ingested(spark.read.parquet(tracker_path), source, start)
        positions, lookbacks = telemetry.newer_than(positions, lookbacks, watermark)
        return telemetry.flat_file(positions, latch_types, vehicle_types, lookbacks)

    run = append_run(
        spark, path, fresh, "sourcesystemdate",
        time="rovertimestamp", tracker=tracker_path, source=source, today=today,
    )
    return run.tracker_row(spark)


def rebuild_flat_file(
    spark: SparkSession, database: str, path: str, start: date = FLAT_FILE_START
) -> None:
    """Replace the flat file by all rows from a partition date on."""
    positions, latch_types, vehicle_types, lookbacks = _flat_file_inputs(
        spark, database, "position", tires=False
    )
    positions, lookbacks = telemetry.flat_file_since(positions, lookbacks, start)
    rows = telemetry.flat_file(positions, latch_types, vehicle_types, lookbacks)
    write_partitioned(rows, path, "sourcesystemdate", "overwrite")


def _survival_by_make_site(spark: SparkSession, database: str, intervals: DataFrame) -> DataFrame:
    names = ("operationalasset", "lookuptable", "operationalview", "tableattribute")
    tables = (catalog_table(spark, database, name) for name in names)
    return survival.survival_by_make_site(intervals, *tables)


def maintenance_reports(
    spark: SparkSession, database: str, orders: DataFrame | None = None
) -> dict[str, DataFrame]:
    """Every maintenance report over the tables of `database`, by name.

    `orders` are the work orders with their types (`maintenance.typed_orders`), if they are at hand.
    """

    def table(name: str) -> DataFrame:
        return catalog_table(spark, database, name)

    asset, codes, view = table("operationalasset"), table("lookuptable"), table("operationalview")
    worktype, meter = table("worktype"), table("meter")
    workorder = table("workorder") if orders is None else orders
    attribute = table("tableattribute")
    margins = maintenance.pm_margin(meter, asset, codes, view, table("task"))
    intervals = survival.survival_dataset(asset, worktype, workorder)
    return {
        "timeline_listing": maintenance.maintenance_timeline(
            asset, codes, view, worktype, workorder
        ),
        "timeline": maintenance.maintenance_timeline(
            asset, codes, view, worktype, workorder, margins
        ),
        "failures_by_make_model": maintenance.failures_by_make_model(
            asset, codes, attribute, worktype, workorder
        ),
        "usage_vs_failures": maintenance.usage_vs_failures(
            asset, codes, view, worktype, workorder, meter
        ),
        "fault_causes": maintenance.fault_causes(asset, codes, view, worktype, workorder),
        "usage_rate": maintenance.usage_rate(asset, codes, view, meter),
        "survival": intervals,
        "survival_by_make_site": _survival_by_make_site(spark, database, intervals),
    }


def run_reports(spark: SparkSession, database: str, path: str) -> None:
    """Write every maintenance report below `path`; the timeline listing as CSV.

    The work orders are read once: with their types, and of their columns those the reports need, they are
    written to `_orders`, which all reports read. The report by make and site is made from the
    survival data as written.
    """
    orders = maintenance.typed_orders(
        catalog_table(spark, database, "workorder"), catalog_table(spark, database, "worktype"), "worktypeid"
    )
    write_report(orders.select(*ORDER_COLUMNS), f"{path}/_orders")
    reports = maintenance_reports(spark, database, spark.read.parquet(f"{path}/_orders"))
    write_report(reports.pop("survival"), f"{path}/survival")
    reports["survival_by_make_site"] = _survival_by_make_site(
        spark, database, spark.read.parquet(f"{path}/survival")
    )
    for name, report in reports.items():
        if name == "timeline_listing":
            write_csv(report, f"{path}/{name}")
        else:
            write_report(report, f"{path}/{name}")
