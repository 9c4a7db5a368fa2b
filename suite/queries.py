"""One query per operator over the benchmark tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from haulmark.functions.text import excludes_all, normalize_make, not_null_text
from haulmark.functions.timeops import local_time, parse_date, year_month
from haulmark.operators.attributes import attribute_columns
from haulmark.operators.history import cumulative_count, since_previous
from haulmark.operators.interval_join import Lookback, interval_join, lookback_joins
from haulmark.operators.latest import (
    any_value_per_key,
    argmax_with_ties,
    drop_tombstones,
    latest_by_maxima,
    snapshot_dimension,
)
from haulmark.operators.skew import dealt_join, heavy_keys, split_join
from haulmark.plans import maintenance, refresh, survival
from haulmark.plans.incremental import incremental_delta, newest_date, newest_time, rows_after
from haulmark.plans.telemetry import (
    enrich_positions,
    flat_file,
    flat_file_since,
    newer_than,
    newer_than_target,
    reading_lookbacks,
)
from haulmark.sources.tracker import ingestion_audit, last_ingested
from suite import standins as s

HOUR, DAY = 3600, 86400
MACHINE = ("mjid", "chid")
FIRST_RAISED = date(1996, 1, 1)


def _lookback(
    spark: SparkSession, sf: str, kind: str, keys: tuple[str, ...], seconds: int, name: str
) -> Lookback:
    columns = {f"{name}_id": "event_id", f"{name}_ts": "ts", f"{name}_value": "value"}
    return Lookback(s.telemetry(spark, sf, kind), keys, "ts", seconds, columns)


def _positions(spark: SparkSession, sf: str) -> DataFrame:
    return s.telemetry(spark, sf, "view")


def _type_tables(spark: SparkSession, sf: str) -> list[tuple[DataFrame, str, str]]:
    latch = s.table(spark, sf, "region").select(
        F.col("r_regionkey").alias("latchtypeid"), F.col("r_name").alias("description")
    )
    vehicle = s.table(spark, sf, "nation").select(
        F.col("n_nationkey").alias("vehicletypeid"), F.col("n_name").alias("description")
    )
    return [(latch, "latchtypeid", "spreaderstate"), (vehicle, "vehicletypeid", "vehicletype")]


def _all_lookbacks(spark: SparkSession, sf: str) -> list[Lookback]:
    return [
        _lookback(spark, sf, "click", MACHINE, 6 * HOUR, "latch"),
        _lookback(spark, sf, "purchase", MACHINE, DAY, "fuel"),
        _lookback(spark, sf, "error", MACHINE, 6 * HOUR, "impact"),
        _lookback(spark, sf, "signup", ("chid",), HOUR, "tire"),
    ]


def q_enrich_positions(spark, sf):
    return enrich_positions(
        _positions(spark, sf), _type_tables(spark, sf), _all_lookbacks(spark, sf), time="ts"
    )


def q_enrich_positions_delta(spark, sf):
    audit = ingestion_audit(
        s.telemetry(spark, sf, "view").where(F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz")),
        "views", "ts", date(2024, 2, 1),
    )
    start = F.lit("2018-08-01").cast("timestamp_ntz")
    positions, lookbacks = newer_than(
        _positions(spark, sf).withColumnRenamed("ts", "rovertimestamp"),
        _all_lookbacks(spark, sf),
        last_ingested(audit, "views", start),
    )
    return enrich_positions(positions, _type_tables(spark, sf), lookbacks)


def q_interval_join_direct(spark, sf):
    fuel = _lookback(spark, sf, "purchase", ("mjid",), DAY, "fuel")
    return interval_join(_positions(spark, sf), "ts", fuel)


def q_interval_join_bucketed(spark, sf):
    fuel = _lookback(spark, sf, "purchase", ("mjid",), DAY, "fuel")
    return lookback_joins(_positions(spark, sf), "ts", [fuel])


def q_interval_join_split_cells(spark, sf):
    lookbacks = [
        _lookback(spark, sf, "purchase", ("chid",), 6 * HOUR, "fuel"),
        _lookback(spark, sf, "error", ("chid",), HOUR, "impact"),
    ]
    return lookback_joins(_positions(spark, sf), "ts", lookbacks, share=0.0005, min_rows=2)


def q_interval_join_composite_key(spark, sf):
    events = s.table(spark, sf, "events").select("event_id", "ts", "user_id", "event_type")
    earlier = Lookback(
        events, ("user_id", "event_type"), "ts", DAY, {"earlier_id": "event_id", "earlier_ts": "ts"}
    )
    return lookback_joins(events, "ts", [earlier])


def _staging(spark, sf):
    kind = F.col("event_type")
    operation = F.when(kind == "error", "D").when(kind == "click", "U").when(
        kind != "signup", "I"
    )
    return s.table(spark, sf, "events").select(
        "event_id", "ts", "user_id", "event_type", "value",
        F.col("ts").alias("audtdateadded"), operation.alias("dboperationtype"),
    )


def _target(spark, sf, before):
    staging = _staging(spark, sf)
    return staging.where(F.col("ts") < F.lit(before).cast("timestamp_ntz")).withColumn(
        "sourcesystemdate", local_time(staging, "ts").cast("date")
    )


def q_incremental_delta(spark, sf):
    return incremental_delta(_staging(spark, sf), _target(spark, sf, "2024-01-20"), event_time="ts")


def q_incremental_empty_target(spark, sf):
    return incremental_delta(_staging(spark, sf), _target(spark, sf, "2000-01-01"), event_time="ts")


def q_delta_future_guard(spark, sf):
    return incremental_delta(
        _staging(spark, sf),
        _target(spark, sf, "2024-01-20"),
        event_time="ts",
        today=F.lit(date(2024, 1, 15)),
    )


def q_scalar_watermark_join(spark, sf):
    events = s.table(spark, sf, "events").select("event_id", "ts", "event_type")
    signups = events.where(
        (F.col("event_type") == "signup")
        & (F.col("ts") < F.lit("2024-01-15").cast("timestamp_ntz"))
    )
    return rows_after(events, "ts", signups.agg(F.max("ts")))


def q_snapshot_dimension(spark, sf):
    return snapshot_dimension(
        s.table(spark, sf, "orders"), ["o_orderstatus", "o_orderpriority"], "o_orderdate"
    )


def q_latest_by_maxima(spark, sf):
    orders = s.table(spark, sf, "orders").select(
        "o_custkey", "o_orderkey", "o_orderdate", "o_totalprice"
    )
    return latest_by_maxima(
        orders, "o_custkey", {"o_orderdate": date(1900, 1, 1), "o_totalprice": 0}
    )


def q_latest_by_max_single(spark, sf):
    orders = s.table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderdate")
    return latest_by_maxima(orders, "o_custkey", {"o_orderdate": None})


def q_argmax_with_ties(spark, sf):
    part = s.table(spark, sf, "part").select("p_partkey", "p_brand", "p_size")
    return argmax_with_ties(part, "p_brand", "p_size")


def q_any_value_per_key(spark, sf):
    return any_value_per_key(
        s.table(spark, sf, "orders"), "o_custkey", "o_orderpriority", "o_orderstatus"
    )


def q_year_month_key(spark, sf):
    day = F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderdate").cast("date"))
    return s.table(spark, sf, "orders").groupBy(year_month(day).alias("yrmon")).agg(
        F.count(F.lit(1)).alias("orders")
    )


def q_local_time_date(spark, sf):
    events = s.table(spark, sf, "events")
    return events.groupBy(local_time(events, "ts").cast("date").alias("local_date")).agg(
        F.count(F.lit(1)).alias("events"), F.max(local_time(events, "ts")).alias("last_local")
    )


def q_ingestion_audit(spark, sf):
    return ingestion_audit(s.table(spark, sf, "events"), "events", "ts", date(2024, 2, 1))


def q_exclude_patterns(spark, sf):
    return s.table(spark, sf, "part").where(
        excludes_all("p_name", ("anvil", "bolt", "old ", "hot ")) & ~F.col("p_type").isin("PROMO")
    ).select("p_partkey", "p_name", "p_type")


def q_null_sentinel_filter(spark, sf):
    balance = F.col("c_acctbal")
    segment = F.when(balance < 0, "NULL").when(balance <= 9000, F.col("c_mktsegment"))
    return (
        s.table(spark, sf, "customer")
        .select("c_custkey", segment.alias("segment"))
        .where(not_null_text("segment"))
    )


def q_semi_join_subset(spark, sf):
    nations = s.table(spark, sf, "nation").join(
        s.table(spark, sf, "region").where(F.col("r_name") == "ASIA"),
        F.col("n_regionkey") == F.col("r_regionkey"), "left_semi",
    )
    customers = s.table(spark, sf, "customer").join(
        nations, F.col("c_nationkey") == F.col("n_nationkey"), "left_semi"
    )
    orders = s.table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return dealt_join(
        orders, customers.withColumnRenamed("c_custkey", "o_custkey"), "o_custkey", "left_semi"
    )


def q_anti_join_never_failed(spark, sf):
    orders = s.table(spark, sf, "orders").select("o_custkey", "o_orderstatus")
    maintained = orders.where(F.col("o_orderstatus") == "O").select("o_custkey").distinct()
    failed = orders.where(F.col("o_orderstatus") == "F").select("o_custkey")
    return dealt_join(maintained, failed, "o_custkey", "left_anti")


def _customers(spark, sf):
    return s.customer_assets(spark, sf), s.code_table(spark, sf), s.views(spark, sf)


def _parts(spark, sf):
    return s.part_assets(spark, sf), s.code_table(spark, sf), s.views(spark, sf)


def q_fault_causes(spark, sf):
    return maintenance.fault_causes(
        *_customers(spark, sf), s.order_types(spark, sf), s.customer_orders(spark, sf),
        cause_key="faultid", sort_keys=s.SORT_KEYS, name_parts=s.CUSTOMER_PARTS,
    )


def q_usage_vs_failures(spark, sf):
    return maintenance.usage_vs_failures(
        *_parts(spark, sf), s.line_types(spark, sf), s.part_orders(spark, sf),
        s.part_meters(spark, sf), value="reading", cause_key="faultid",
        sort_keys=s.SORT_KEYS, name_parts=s.PART_PARTS,
    )


def q_usage_vs_failures_code_value(spark, sf):
    return maintenance.usage_vs_failures(
        *_parts(spark, sf), s.line_types(spark, sf), s.part_orders(spark, sf),
        s.part_meters(spark, sf), cause_key=None,
        sort_keys=s.SORT_KEYS, name_parts=s.PART_PARTS,
    )


def q_usage_rate(spark, sf):
    return maintenance.usage_rate(
        *_parts(spark, sf), s.part_meters(spark, sf), value="reading",
        sort_keys=s.SORT_KEYS, name_parts=s.PART_PARTS,
    )


def _margins(spark, sf):
    return maintenance.pm_margin(
        s.customer_meters(spark, sf), *_customers(spark, sf), s.customer_tasks(spark, sf),
        value="reading",
    )


def q_pm_margin(spark, sf):
    return _margins(spark, sf)


def q_pm_margin_cleanup(spark, sf):
    return maintenance.pm_margin(
        s.customer_meters(spark, sf), *_customers(spark, sf), s.customer_tasks(spark, sf),
        value="reading", cleanup=True,
    )


def q_maintenance_listing(spark, sf):
    return maintenance.maintenance_timeline(
        *_customers(spark, sf), s.order_types(spark, sf), s.customer_orders(spark, sf),
        sort_keys=s.SORT_KEYS, name_parts=s.CUSTOMER_PARTS,
    )


def q_maintenance_timeline(spark, sf):
    return maintenance.maintenance_timeline(
        *_customers(spark, sf), s.order_types(spark, sf), s.customer_orders(spark, sf),
        _margins(spark, sf), sort_keys=s.SORT_KEYS, name_parts=s.CUSTOMER_PARTS,
    )


def q_pm_schedule(spark, sf):
    return maintenance.pm_schedule(_margins(spark, sf)).select(
        "operationalassetid", "frequency", "estimated", "pm_margin_days", "due"
    )


def q_pm_compliance(spark, sf):
    finished = s.customer_orders(spark, sf).where(F.col("worktypeid") == "O")
    return maintenance.pm_compliance(maintenance.pm_schedule(_margins(spark, sf)), finished)


def q_eav_attributes(spark, sf):
    return attribute_columns(s.part_attributes(spark, sf), s.code_table(spark, sf))


def q_normalize_make(spark, sf):
    name = F.concat(F.lit("\t "), F.upper("p_name"), F.lit(" \n"))
    return s.table(spark, sf, "part").select(
        "p_partkey", normalize_make(name, s.PART_MAKES).alias("make")
    )


def q_failures_by_make_model(spark, sf):
    return maintenance.failures_by_make_model(
        s.part_assets(spark, sf), s.code_table(spark, sf), s.part_attributes(spark, sf),
        s.line_types(spark, sf), s.part_orders(spark, sf),
        sort_keys=s.SORT_KEYS, name_parts=s.PART_PARTS, spellings=s.PART_MAKES,
    )


def q_time_since_previous(spark, sf):
    orders = s.table(spark, sf, "orders").select(
        "o_custkey", "o_orderkey", F.col("o_orderdate").cast("date").alias("day")
    )
    first = orders.agg(F.min("day")).scalar()
    return since_previous(orders, "o_custkey", "day", "o_orderkey", first, "previous", "gap_days")


def q_asof_cumulative_count(spark, sf):
    events = s.table(spark, sf, "events").select("event_id", "user_id", "ts", "event_type")
    errors = events.where(F.col("event_type") == "error").drop("event_type")
    purchases = events.where(F.col("event_type") == "purchase")
    return cumulative_count(errors, purchases, ["user_id"], "ts", "ts", "purchases_so_far")


def q_asof_cumulative_count_by_day(spark, sf):
    orders = s.customer_orders(spark, sf)
    failed = orders.where(F.col("worktypeid") == "F").select(
        "workorderid", "operationalassetid", "raisedate"
    )
    done = orders.where(F.col("worktypeid") == "O")
    return cumulative_count(
        failed, done, ["operationalassetid"], "raisedate", "finishdate", "maintained"
    )


def _survival(spark, sf):
    return survival.survival_dataset(
        s.customer_assets(spark, sf), s.order_types(spark, sf), s.customer_orders(spark, sf),
        first_raised=FIRST_RAISED,
    )


def q_survival_dataset(spark, sf):
    return _survival(spark, sf)


def q_survival_by_make_site(spark, sf):
    return survival.survival_by_make_site(
        _survival(spark, sf), *_customers(spark, sf), s.customer_attributes(spark, sf),
        sort_keys=s.SORT_KEYS, spellings=s.SEGMENT_MAKES,
    )


def q_equi_join_split_keys(spark, sf):
    lines = s.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_returnflag"
    )
    types = s.line_types(spark, sf).withColumnRenamed("worktypeid", "l_returnflag")
    parts = s.table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), "p_name")
    heavy_flag, heavy_part = heavy_keys(
        [(lines, "l_returnflag"), (lines, "l_partkey")], share=0.0005, min_rows=5
    )
    typed = split_join(lines, types, "l_returnflag", heavy_flag)
    return split_join(typed, parts, "l_partkey", heavy_part)


def q_tombstone_filter(spark, sf):
    return drop_tombstones(_staging(spark, sf)).select("event_id", "dboperationtype")


def q_two_level_watermark(spark, sf):
    target = _target(spark, sf, "2024-01-20")
    newest = newest_date(target, "sourcesystemdate", today=F.lit(date(2024, 1, 18)))
    latest = newest_time(target, "sourcesystemdate", "ts", newest)
    return latest.select(F.col("ts").alias("newest_time"), newest.scalar().alias("newest_date"))


def q_tracker_watermark(spark, sf):
    audits = [
        ingestion_audit(s.telemetry(spark, sf, kind), kind, "ts", date(2024, 2, 1))
        for kind in ("view", "click")
    ]
    start = F.lit("2018-08-01").cast("timestamp_ntz")
    tracker = audits[0].unionByName(audits[1])
    return last_ingested(tracker, "click", start)


def q_fixed_date_cutoff(spark, sf):
    positions = _positions(spark, sf).withColumn("sourcesystemdate", F.col("ts").cast("date"))
    fuel = s.telemetry(spark, sf, "purchase").withColumn(
        "sourcesystemdate", F.col("ts").cast("date")
    )
    columns = {"fuel_id": "event_id", "fuel_ts": "ts"}
    recent, lookbacks = flat_file_since(
        positions, [Lookback(fuel, MACHINE, "ts", DAY, columns)], date(2024, 1, 16)
    )
    return lookback_joins(recent, "ts", lookbacks)


def _flat_sides(spark, sf):
    positions, *readings = (
        s.flat_side(spark, sf, kind) for kind in ("view", "click", "purchase", "error", "signup")
    )
    tires = readings[-1].drop("mjid", "latchtypeid", "vehicletypeid")
    types = [types for types, _, _ in _type_tables(spark, sf)]
    return positions, types, reading_lookbacks(*readings[:3], tires)


def q_flat_file(spark, sf):
    positions, types, lookbacks = _flat_sides(spark, sf)
    return flat_file(positions, *types, lookbacks)


def q_flat_file_delta(spark, sf):
    positions, types, lookbacks = _flat_sides(spark, sf)
    hours = (1, 60, 1, 1)
    longer = [replace(lookback, seconds=h * HOUR) for lookback, h in zip(lookbacks, hours)]
    target = positions.where(F.col("sourcesystemdate") < F.lit(date(2024, 1, 20)))
    positions, longer = newer_than_target(positions, longer, target)
    return flat_file(positions, *types, longer)


def _vehicle_staging(spark, sf, names, given):
    """Orders as vehicle or rover records: one machine per customer, the columns of `given` filled."""
    deleted = F.when(F.col("o_orderpriority") == "5-LOW", "D").otherwise("I")
    columns = [given.get(name, F.lit(None).cast("string")).alias(name) for name in names]
    return s.table(spark, sf, "orders").select(*columns, deleted.alias("dboperationtype"))


def _machine_columns():
    dated = F.col("o_orderdate")
    return {
        "mjid": F.col("o_custkey"),
        "chid": F.col("o_orderkey"),
        "sourcesystem": F.col("o_orderpriority"),
        "lastdetailtimestamp": F.when(F.col("o_orderstatus") != "P", dated),
    }


def q_vehicle_details(spark, sf):
    never = F.lit(None).cast("timestamp_ntz")
    given = {name: never for name in refresh.VEHICLE_COLUMNS if name.endswith("timestamp")}
    given |= _machine_columns() | {"vehiclesubtypeid": F.month("o_orderdate")}
    found = refresh.vehicle_details(_vehicle_staging(spark, sf, refresh.VEHICLE_COLUMNS, given))
    return found.select(
        "mjid", "chid", "sourcesystem", "lastdetailtimestamp", "lastfueltimestamp",
        "vehiclesubtypeid", "yrmon",
    )


def _rover_details(spark, sf, latest_only):
    given = _machine_columns() | {"startuptimestamp": F.col("o_orderdate")}
    rows = _vehicle_staging(spark, sf, refresh.ROVER_COLUMNS, given)
    return refresh.rover_details(rows, latest_only).select(
        "mjid", "chid", "sourcesystem", "lastdetailtimestamp", "startuptimestamp", "yrmon",
        "sourcesystemtimestamp",
    )


def q_rover_details(spark, sf):
    return _rover_details(spark, sf, latest_only=False)


def q_rover_details_latest(spark, sf):
    return _rover_details(spark, sf, latest_only=True)


def q_dimension_required(spark, sf):
    dated = F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority"))
    orders = s.table(spark, sf, "orders").select(
        dated.alias("maptypeid"), "o_orderstatus", "o_orderdate"
    )
    return snapshot_dimension(
        orders, ["maptypeid", "o_orderstatus"], "o_orderdate", not_null=["maptypeid"]
    )


def q_union_missing_columns(spark, sf):
    events = s.table(spark, sf, "events")
    raised = events.where(F.col("event_type") == "error").select(
        "event_id", F.col("ts").alias("raised")
    )
    finished = events.where(F.col("event_type") == "purchase").select(
        "event_id", F.col("ts").alias("finished"), "value"
    )
    return raised.unionByName(finished, allowMissingColumns=True)


def q_date_parse_strict(spark, sf):
    text = F.when(F.col("o_orderpriority") == "5-LOW", "bad").otherwise(
        F.date_format("o_orderdate", "M/d/yy")
    )
    return s.table(spark, sf, "orders").select("o_orderkey", parse_date(text).alias("day"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    name[2:]: query for name, query in list(globals().items()) if name.startswith("q_")
}
