"""Properties of the physical plans, with every join kept from broadcasting."""

from __future__ import annotations

import re
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from haulmark.operators.interval_join import Lookback, lookback_joins
from haulmark.operators.latest import latest_by_maxima, snapshot_dimension
from haulmark.plans.incremental import incremental_delta
from haulmark.sources.sinks import write_partitioned
from suite import queries, standins

SF_DIR = "/root/testdata/sf0.001"
LOW_CARDINALITY = {
    "worktypeid", "faultid", "latchtypeid", "vehicletypeid", "attributenameid", "sortkeyid",
    "operationalviewid", "make", "makenmod", "operationalassetname",
}


@pytest.fixture(autouse=True)
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_no_query_pairs_all_rows_or_broadcasts_unchecked(spark, name):
    text = plan(queries.QUERIES[name](spark, SF_DIR))
    assert "CartesianProduct" not in text
    assert "NestedLoop" not in text
    # With automatic broadcasts off, what is left are tables of the bounded heavy groups and
    # lookup tables whose rows were counted.
    for line in text.splitlines():
        if "BroadcastHashJoin" in line:
            assert "_hash" in line or "_measured_" in line, line


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_facts_are_not_gathered_by_a_key_of_few_values(spark, name):
    """On such a key alone only aggregates are shuffled, a row per key and task."""
    lines = plan(queries.QUERIES[name](spark, SF_DIR)).splitlines()
    for line, below in zip(lines, lines[1:]):
        alone = re.search(r"Exchange hashpartitioning\((\w+)#\d+L?, \d+\)", line)
        if alone and alone[1] in LOW_CARDINALITY:
            assert "Aggregate(" in below and "partial_" in below or "functions=[]" in below, line


def test_lookbacks_on_the_same_keys_share_one_shuffle_of_the_events(spark):
    positions = standins.telemetry(spark, SF_DIR, "view")
    keys = ("mjid", "chid")
    lookbacks = [
        queries._lookback(spark, SF_DIR, kind, keys, seconds, kind)
        for kind, seconds in (("click", 3600), ("purchase", 86400), ("error", 900), ("signup", 2000))
    ]
    text = plan(queries.lookback_joins(positions, "ts", lookbacks))
    assert len(re.findall(r"Exchange hashpartitioning\(mjid", text)) == 2
    assert len(re.findall(r"Exchange hashpartitioning\(_r_mjid", text)) == 4


def test_lookbacks_that_multiply_the_events_are_joined_last(spark):
    """Their rows are shuffled no more: by yard an event meets 30 readings in an hour, by machine 2 in four."""
    start = datetime(2024, 1, 1)
    rows = [(i, i % 100, i % 2, start + timedelta(minutes=i)) for i in range(600)]
    events = spark.createDataFrame(rows, "id int, machine int, yard int, ts timestamp_ntz")
    lookbacks = [
        Lookback(events, ("yard",), "ts", 3600, {"in_yard": "id"}),
        Lookback(events, ("machine",), "ts", 4 * 3600, {"of_machine": "id"}),
        Lookback(events, ("machine", "yard"), "ts", 60, {"now": "id"}),
    ]
    for given in (lookbacks, lookbacks[::-1]):
        joined = lookback_joins(events, "ts", given)
        # the plan's first lines are its last steps
        assert re.findall(r"Exchange hashpartitioning\((\w+)#\d+, (?:yard#\d+, )?_cell", plan(joined)) == ["yard", "machine", "machine"]
        names = sorted(joined.columns)
        plain = lookback_joins(events, "ts", given, share=None).select(names)
        assert sorted(map(str, joined.select(names).collect())) == sorted(map(str, plain.collect()))


def test_watermarks_prune_the_target_and_reach_the_staging_scan(spark, tmp_path):
    events = standins.table(spark, SF_DIR, "events").select(
        "event_id", "ts", F.lit("I").alias("dboperationtype"), F.col("ts").alias("audtdateadded")
    )
    path = str(tmp_path / "target")
    rows = events.where(F.col("ts") < F.lit(date(2024, 1, 9))).withColumn(
        "sourcesystemdate", F.col("ts").cast("date")
    )
    write_partitioned(rows, path, "sourcesystemdate", "append")
    delta = incremental_delta(events, spark.read.parquet(path), event_time="ts")
    text = delta._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    assert re.search(r"PartitionFilters: \[.*sourcesystemdate.* = Subquery", text)
    assert re.search(r"PushedFilters: \[.*GreaterThan\(ts,ScalarSubquery", text)
    assert "ReadSchema: struct<>" in text


def test_newest_rows_need_no_window(spark):
    orders = standins.table(spark, SF_DIR, "orders")
    text = plan(latest_by_maxima(orders, "o_custkey", {"o_orderdate": None}))
    assert "Window" not in text and "LeftSemi" in text
    text = plan(snapshot_dimension(orders, ["o_orderstatus"], "o_orderdate"))
    assert text.count("Exchange") == 1 and "partial_max" in text


def test_windows_run_over_bounded_groups_only(spark):
    """A key alone partitions a window only after its rows are summed per day."""
    text = plan(queries.q_asof_cumulative_count(spark, SF_DIR))
    assert re.findall(r"windowspecdefinition\((user_id#\d+L?, \w+)", text)
    for name in ("asof_cumulative_count", "time_since_previous", "survival_dataset"):
        lines = plan(queries.QUERIES[name](spark, SF_DIR)).splitlines()
        for number, line in enumerate(lines):
            if "Window [" in line:
                below = "\n".join(lines[number : number + 8])
                assert "HashAggregate" in below, line


def test_semi_and_anti_joins_are_planned_as_such(spark):
    assert "LeftSemi" in plan(queries.q_semi_join_subset(spark, SF_DIR))
    assert "LeftAnti" in plan(queries.q_anti_join_never_failed(spark, SF_DIR))


def test_scans_read_only_the_columns_they_need(spark):
    text = plan(queries.q_ingestion_audit(spark, SF_DIR))
    assert "ReadSchema: struct<ts:timestamp_ntz>" in text


def test_instants_are_read_and_shuffled_once(spark):
    df = queries.q_asof_cumulative_count(spark, SF_DIR)
    df.collect()
    final = plan(df).split("Initial Plan")[0]
    assert len(re.findall(r"FileScan", final)) <= 3
    assert "ReusedExchange" in final
