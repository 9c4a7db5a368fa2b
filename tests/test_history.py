from __future__ import annotations

import random
from collections import Counter
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from haulmark.operators.history import cumulative_count, running_total, since_previous

START = datetime(2023, 12, 31, 23, 59, 58)


def rows(df):
    return Counter(tuple(row) for row in df.collect())


@pytest.mark.parametrize("kind", ["timestamp_ntz", "timestamp", "date"])
@pytest.mark.parametrize("seed", [1, 2])
def test_cumulative_count_equals_brute_force(spark, kind, seed):
    """Random keys and times with ties, missing ones, and one key holding a third of the rows."""
    pick = random.Random(seed)

    def moment():
        if pick.random() < 0.05:
            return None
        step = pick.choice([timedelta(0), timedelta(microseconds=1), timedelta(seconds=1), timedelta(days=1)])
        at = START + step * pick.randrange(4)
        return at.date() if kind == "date" else at

    def key():
        return "hot" if pick.random() < 0.34 else pick.choice(["a", "b", None])

    events = [(i, key(), moment()) for i in range(120)]
    counted = [(key(), moment()) for _ in range(150)]
    found = cumulative_count(
        spark.createDataFrame(events, f"id int, k string, at {kind}"),
        spark.createDataFrame(counted, f"k string, done {kind}"),
        ["k"], "at", "done", "n",
    )
    expected = Counter(
        (i, k, at, sum(1 for c, d in counted if k is not None and at is not None and c == k
                       and d is not None and d <= at))
        for i, k, at in events
    )
    assert rows(found) == expected


def test_running_total_spans_days_seconds_and_instants(spark):
    steps = [0, 1, 999_999, 1_000_000, 1_000_001, 86_400_000_000, 90_000_000_000]
    data = [("k", START + timedelta(microseconds=step), 2) for step in steps]
    df = spark.createDataFrame(data, "k string, at timestamp_ntz, n int")
    found = running_total(df, ["k"], "at", "n").orderBy("at").collect()
    assert [row["n"] for row in found] == [2, 4, 6, 8, 10, 12, 14]


def test_gap_to_the_previous_event_of_the_key(spark):
    df = spark.createDataFrame(
        [
            (1, "a", date(2020, 1, 10)), (2, "a", date(2020, 1, 4)), (3, "a", date(2020, 1, 10)),
            (4, "b", date(2020, 1, 5)), (5, None, date(2020, 1, 5)), (6, "a", None),
        ],
        "id int, k string, day date",
    )
    found = since_previous(df, "k", "day", "id", F.lit(date(2020, 1, 1)), "before", "gap")
    by_id = {row["id"]: (row["before"], row["gap"]) for row in found.collect()}
    assert by_id == {
        2: (date(2020, 1, 1), 3),
        1: (date(2020, 1, 4), 6),
        3: (date(2020, 1, 10), 0),
        4: (date(2020, 1, 1), 4),
        5: (None, None),
        6: (None, None),
    }


def test_rows_without_a_key_are_spread_and_crowded_instants_stay_whole(spark):
    at = datetime(2024, 1, 1)
    rows = [(None if i % 3 == 0 else 1, at if i % 3 == 1 else at + timedelta(seconds=i)) for i in range(6000)]
    events = spark.createDataFrame(rows, "key int, ts timestamp_ntz").repartition(4)
    found = cumulative_count(events, events, ["key"], "ts", "ts", "n")
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.coalescePartitions.enabled")
    before = {name: spark.conf.get(name) for name in names}
    for name, value in zip(names, ("-1", "false")):
        spark.conf.set(name, value)
    try:
        parts = found.where("key is null").groupBy(F.spark_partition_id()).count().collect()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert len(parts) > 1 and max(r["count"] for r in parts) < 1500
    counts = Counter((r["key"], r["n"]) for r in found.where(F.col("ts") == at).collect())
    assert counts == Counter({(1, 2000): 2000, (None, 0): 1})
