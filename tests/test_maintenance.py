from __future__ import annotations

import random
from collections import Counter
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from haulmark import schemas
from haulmark.plans import maintenance

D = date


def rows(df, *columns):
    return Counter(tuple(row) for row in (df.select(*columns) if columns else df).collect())


@pytest.fixture(scope="module")
def world(spark):
    """A small yard: assets 1-3 qualify, 4 and 5 are excluded, 6 has no view."""
    frame = lambda data, schema: spark.createDataFrame(data, schema)
    return {
        "asset": frame(
            [
                (1, "RTG 1", "crane", D(2010, 5, 1), 1, 10),
                (2, "RTG 2", "crane", D(2011, 1, 1), 1, 10),
                (3, "TRUCK 3", "truck", None, 2, 11),
                (4, "LIGHT 4", "light", D(2012, 1, 1), 1, 12),
                (5, "TRUCK GROUP", "truck", D(2012, 1, 1), 1, 11),
                (6, "RTG 6", "crane", D(2012, 1, 1), 9, 10),
            ],
            schemas.OPERATIONAL_ASSET,
        ),
        "codes": frame(
            [
                (10, "CRANE", "7", "crane key"), (11, "TRUCK", "x", "truck key"),
                (12, "AUXILIARY", "5", "aux key"), (20, "c", "0", "flat tire"),
                (21, "c", "0", "NULL"), (22, "c", "0", None), (30, "MAKE", "0", "m"),
                (31, "MODEL NO", "0", "n"),
            ],
            schemas.LOOKUP_TABLE,
        ),
        "view": frame([(1, "NORTH"), (2, "SOUTH")], schemas.OPERATIONAL_VIEW),
        "worktype": frame(
            [(100, "FAIL", "Failure"), (101, "PM", "Maintenance"), (102, "SCH", "Other")],
            schemas.WORK_TYPE,
        ),
        "workorder": frame(
            [
                (20, 1, 100, D(2019, 1, 5), None), (21, 1, 100, D(2019, 2, 5), None),
                (22, 1, 101, D(2019, 1, 1), D(2019, 1, 9)), (20, 1, 101, D(2019, 1, 1), None),
                (20, 2, 100, None, None), (20, 3, 102, D(2019, 3, 1), None),
                (20, 3, 100, D(2019, 3, 2), None), (20, 4, 100, D(2019, 3, 3), None),
                (20, 5, 100, D(2019, 3, 4), None), (20, 6, 100, D(2019, 3, 5), None),
                (20, 99, 100, D(2019, 3, 5), None),
            ],
            schemas.WORK_ORDER,
        ),
        "meter": frame(
            [
                (1, D(2019, 1, 1), D(2019, 1, 1), "m", "Hour Meter"),
                (1, D(2019, 3, 12), D(2019, 1, 1), "m", "Hour Meter"),
                (1, D(2020, 3, 12), D(2019, 1, 1), "m", "Odometer"),
                (2, D(2019, 1, 1), D(2019, 1, 1), "m", "Hour Meter"),
                (3, D(2019, 1, 1), D(2019, 1, 1), "m", "Hour Meter"),
                (4, D(2019, 1, 1), D(2019, 1, 1), "m", "Hour Meter"),
                (4, D(2019, 1, 3), D(2019, 1, 1), "m", "Hour Meter"),
            ],
            schemas.METER,
        ),
        "task": frame(
            [(1, 2, 30), (1, 2, 40), (1, 1, 99), (2, 1, 10), (4, 1, 10), (99, 1, 1)], schemas.TASK
        ),
    }


def sides(world, *names):
    return [world[name] for name in names]


def margins(world, **options):
    return maintenance.pm_margin(*sides(world, "meter", "asset", "codes", "view", "task"), **options)


def test_margin_uses_the_code_value_per_reading_and_keeps_task_ties(world):
    found = rows(
        margins(world),
        "operationalassetid", "value", "daterange", "frequency", "estimated", "pm_margin_days",
    )
    # 70 days, two readings of 7; a single reading has no days; text values are missing.
    assert found == Counter(
        {
            (1, 14, 70.0, 30, 150.0, 1750.0): 1,
            (1, 14, 70.0, 40, 200.0, 1750.0): 1,
            (2, 7, 0.0, 10, 0.0, 0.0): 1,
            (4, 10, 2.0, 10, 2.0, 70.0): 1,
        }
    )
    assert rows(margins(world, cleanup=True), "operationalassetid") == Counter({(4,): 1})


def timeline(world, *extra, **options):
    return maintenance.maintenance_timeline(
        *sides(world, "asset", "codes", "view", "worktype", "workorder"), *extra, **options
    )


def test_listing_labels_orders_and_counts_failures_per_name(world):
    found = rows(timeline(world))
    assert found == Counter(
        {
            (1, "RTG 1", "NORTH", "CRANE", D(2019, 1, 5), "Failure", 2): 1,
            (1, "RTG 1", "NORTH", "CRANE", D(2019, 2, 5), "Failure", 2): 1,
            (1, "RTG 1", "NORTH", "CRANE", D(2019, 1, 9), "PM Completed", 2): 1,
            (1, "RTG 1", "NORTH", "CRANE", None, "", 2): 1,
            (2, "RTG 2", "NORTH", "CRANE", None, "", 0): 1,
            (3, "TRUCK 3", "SOUTH", "TRUCK", D(2019, 3, 2), "Failure", 1): 1,
            # The sort key of asset 4 is excluded: its rows stay, its names do not.
            (4, None, None, None, D(2019, 3, 3), "Failure", 0): 1,
        }
    )


def test_final_timeline_has_labelled_rows_with_a_margin(world):
    found = rows(timeline(world, margins(world)), "operationalassetid", "all", "type", "done")
    assert found == Counter(
        {
            (1, D(2019, 1, 5), "Failure", None): 2,
            (1, D(2019, 2, 5), "Failure", None): 2,
            (1, D(2019, 1, 9), "PM Completed", None): 2,
            (4, D(2019, 3, 3), "Failure", None): 1,
        }
    )


def test_fault_causes_keep_assets_without_any(world):
    found = rows(
        maintenance.fault_causes(*sides(world, "asset", "codes", "view", "worktype", "workorder"))
    )
    assert found == Counter(
        {
            (1, "RTG 1", "flat tire", "NORTH", "Failure", D(2010, 5, 1), "CRANE"): 1,
            (2, "RTG 2", "flat tire", "NORTH", "Failure", D(2011, 1, 1), "CRANE"): 1,
            (3, "TRUCK 3", "flat tire", "SOUTH", "Failure", None, "TRUCK"): 1,
            (6, "RTG 6", None, None, None, D(2012, 1, 1), "CRANE"): 1,
        }
    )


def test_usage_vs_failures_needs_both(world):
    found = rows(
        maintenance.usage_vs_failures(
            *sides(world, "asset", "codes", "view", "worktype", "workorder", "meter")
        )
    )
    assert found == Counter(
        {
            (1, D(2010, 5, 1), 21.0, "Odometer", 2, "RTG 1", "NORTH"): 1,
            (2, D(2011, 1, 1), 7.0, "Hour Meter", 1, "RTG 2", "NORTH"): 1,
            (3, None, None, "Hour Meter", 1, "TRUCK 3", "SOUTH"): 1,
        }
    )


def test_usage_rate_is_null_without_days_and_keeps_excluded_assets(world):
    found = rows(
        maintenance.usage_rate(*sides(world, "asset", "codes", "view", "meter")),
        "operationalassetid", "sumofvalue", "date_diff", "ratio", "name", "sortkeyname",
    )
    assert found == Counter(
        {
            (1, 21.0, 436.0, 21.0 / 436.0, "RTG 1", "CRANE"): 1,
            (2, 7.0, 0.0, None, "RTG 2", "CRANE"): 1,
            (3, None, 0.0, None, "TRUCK 3", "TRUCK"): 1,
            (4, 10.0, 2.0, 5.0, "LIGHT 4", None): 1,
        }
    )


def test_failures_by_make_and_model(spark, world):
    attribute = spark.createDataFrame(
        [
            (1, 30, " CHEVY"), (1, 31, "X1 "), (2, 30, "chevrolet"), (2, 31, "x1"),
            (3, 30, "NULL"), (3, 31, "x1"), (4, 30, "chev"), (4, 31, "x1"), (6, 30, "mafi"),
            (6, 31, None),
        ],
        schemas.TABLE_ATTRIBUTE,
    )
    found = rows(
        maintenance.failures_by_make_model(
            *sides(world, "asset", "codes"), attribute, *sides(world, "worktype", "workorder")
        ),
        "operationalassetid", "make", "makenmod", "worktypename", "countofassetmakes",
        "countofmakesinworkorders", "countofmodels", "countofassetmodels",
        "causeoffaultdescription",
    )
    assert found == Counter(
        {
            (1, "chevrolet", "chevrolet-x1", "FAIL", 2, 3, 3, 2, "crane key"): 2,
            (2, "chevrolet", "chevrolet-x1", "FAIL", 2, 3, 3, 2, "crane key"): 1,
            (6, "mafi", None, "FAIL", 1, 1, None, None, "crane key"): 1,
        }
    )


def margin_rows(spark, *data):
    return spark.createDataFrame(
        data,
        "operationalassetid int, mindate date, maxdate date, estimated double, pm_margin_days double",
    )


def test_schedule_runs_from_first_to_last_reading(spark):
    found = maintenance.pm_schedule(
        margin_rows(
            spark,
            (1, D(2019, 1, 1), D(2019, 1, 21), 10.0, 3.0),
            (2, D(2019, 1, 1), D(2019, 1, 5), 0.0, 3.0),
            (3, D(2019, 1, 1), D(2019, 1, 5), None, None),
            (4, D(2019, 1, 1), D(2019, 1, 1), 5.0, 3.0),
        )
    )
    assert rows(found, "operationalassetid", "due") == Counter(
        {(1, D(2019, 1, 1)): 1, (1, D(2019, 1, 11)): 1, (1, D(2019, 1, 21)): 1, (4, D(2019, 1, 1)): 1}
    )


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_compliance_equals_row_by_row_matching(spark, seed):
    pick = random.Random(seed)
    start = D(2019, 1, 1)
    schedule, completions = [], []
    for asset in range(12):
        margin = float(pick.randrange(0, 6))
        schedule += [
            (asset, start + timedelta(days=pick.randrange(40)), margin) for _ in range(pick.randrange(12))
        ]
        completions += [
            (asset, None if pick.random() < 0.1 else start + timedelta(days=pick.randrange(45)))
            for _ in range(pick.randrange(12))
        ]
    expected = Counter()
    for asset in range(12):
        free = sorted(day for a, day in completions if a == asset and day is not None)
        for _, due, margin in sorted(row for row in schedule if row[0] == asset):
            until = due + timedelta(days=margin)
            hit = next((day for day in free if due <= day <= until), None)
            if hit is not None:
                free.remove(hit)
            expected[(asset, due, until, hit is not None)] += 1
    found = maintenance.pm_compliance(
        spark.createDataFrame(schedule, "operationalassetid int, due date, pm_margin_days double"),
        spark.createDataFrame(completions, "operationalassetid int, finishdate date"),
    )
    assert rows(found) == expected


@pytest.mark.parametrize("seed", range(6))
def test_compliance_of_windows_of_any_length(spark, seed):
    """Margins that differ within an asset, missing and endless ones; against serving window by window."""
    pick = random.Random(seed)
    start = D(2019, 1, 1)
    margins = [None, 5e9, *map(float, range(9))]
    schedule, completions = [], []
    for asset in range(30):
        day = lambda: start + timedelta(days=pick.randrange(15 + asset))
        schedule += [(asset, day(), pick.choice(margins)) for _ in range(pick.randrange(14))]
        completions += [(asset, day()) for _ in range(pick.randrange(10))]
    expected = Counter()
    for asset in range(30):
        free = sorted(day for a, day in completions if a == asset)
        windows = []
        for _, due, margin in (row for row in schedule if row[0] == asset):
            last = D(1, 1, 1) if margin is None else date.max if margin > 1e6 else due + timedelta(days=margin)
            windows.append((last, due, margin))
        for last, due, margin in sorted(windows, key=lambda w: w[:2]):
            hit = next((day for day in free if due <= day <= last), None)
            if hit is not None:
                free.remove(hit)
            expected[(asset, due, last if margin is not None and margin < 1e6 else None, hit is not None)] += 1
    found = maintenance.pm_compliance(
        spark.createDataFrame(schedule, "operationalassetid int, due date, pm_margin_days double"),
        spark.createDataFrame(completions, "operationalassetid int, finishdate date"),
    )
    assert rows(found) == expected
    assert "Python" not in found._jdf.queryExecution().executedPlan().toString()


def test_an_odd_interval_or_many_copies_stop_no_report(spark):
    start, end = date(2020, 1, 1), date(2020, 3, 1)
    rows = [(1, start, end, 5e9, 7e12), (2, start, end, 30.0, 5.0)]
    margins = spark.createDataFrame(
        rows, "operationalassetid bigint, mindate date, maxdate date, estimated double, pm_margin_days double"
    )
    due = maintenance.pm_schedule(margins)
    assert Counter((r["operationalassetid"], r["due"]) for r in due.collect()) == Counter(
        [(1, start), (2, start), (2, date(2020, 1, 31)), (2, end)]
    )
    copies = due.where("operationalassetid = 2 and due = date'2020-01-31'").crossJoin(spark.range(1_000_000)).drop("id")
    done = spark.createDataFrame([(1, end), (2, date(2020, 2, 1))], "operationalassetid bigint, finishdate date")
    found = maintenance.pm_compliance(copies.unionByName(due.where("operationalassetid = 1")), done)
    counts = {(r["operationalassetid"], r["done"]): r["count"] for r in found.groupBy("operationalassetid", "done").count().collect()}
    assert counts == {(1, True): 1, (2, True): 1, (2, False): 999_999}
