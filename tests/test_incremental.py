from __future__ import annotations

from collections import Counter
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from haulmark.plans.incremental import incremental_delta, today_in
from haulmark.sources.sinks import write_partitioned
from haulmark.sources.tracker import ingestion_audit, last_ingested, write_with_audit
from haulmark.streaming.delta_stream import ingest_new_files

STAGING = "chid string, rovertimestamp timestamp, audtdateadded timestamp, dboperationtype string"
TARGET = (
    "chid string, rovertimestamp timestamp, sourcesystemtimestamp timestamp, sourcesystemdate date"
)
NOON = datetime(2019, 6, 1, 12)


def rows(df):
    return Counter(tuple(row) for row in df.collect())


def staged(spark, *records):
    data = [(chid, at, audit, op) for chid, at, audit, op in records]
    return spark.createDataFrame(data, STAGING)


def target(spark, *times):
    df = spark.createDataFrame([("t", at) for at in times], "chid string, rovertimestamp timestamp")
    local = F.from_utc_timestamp("rovertimestamp", "America/New_York")
    return df.select(
        "*", local.alias("sourcesystemtimestamp"), local.cast("date").alias("sourcesystemdate")
    )


def test_deletions_duplicates_and_known_rows_are_left_out(spark):
    late = NOON - timedelta(hours=1)
    staging = staged(
        spark,
        ("new", NOON + timedelta(seconds=1), NOON, "I"),
        ("new", NOON + timedelta(seconds=1), NOON + timedelta(hours=5), "U"),
        ("gone", NOON + timedelta(seconds=2), NOON, "D"),
        ("none", NOON + timedelta(seconds=2), NOON, None),
        ("equal", NOON, NOON, "I"),
        ("late", late, NOON, "I"),
        ("old", NOON - timedelta(days=3), NOON, "I"),
    )
    found = incremental_delta(staging, target(spark, NOON, late))
    assert found.columns == ["chid", "rovertimestamp", "sourcesystemtimestamp", "sourcesystemdate"]
    assert rows(found) == Counter(
        {("new", NOON + timedelta(seconds=1), datetime(2019, 6, 1, 8, 0, 1), date(2019, 6, 1)): 1}
    )


def test_empty_target_starts_at_the_default(spark):
    staging = staged(
        spark, ("a", datetime(2017, 7, 30, 12), NOON, "I"), ("b", datetime(2017, 8, 2), NOON, "I")
    )
    empty = spark.createDataFrame([], TARGET)
    assert [row["chid"] for row in incremental_delta(staging, empty).collect()] == ["b"]


def test_future_partitions_are_ignored_when_guarded(spark):
    staging = staged(spark, ("a", NOON + timedelta(hours=1), NOON, "I"))
    known = target(spark, NOON, datetime(2999, 1, 1))
    assert incremental_delta(staging, known).count() == 0
    assert incremental_delta(staging, known, today=date(2019, 6, 2)).count() == 1
    assert incremental_delta(staging, known, today=today_in()).count() == 1


def test_second_run_adds_nothing(spark, tmp_path):
    path = str(tmp_path / "target")
    spark.createDataFrame([], TARGET).write.partitionBy("sourcesystemdate").parquet(path)
    staging = staged(spark, *[(str(i), NOON + timedelta(hours=7 * i), NOON, "I") for i in range(9)])

    def run():
        known = spark.read.schema(TARGET).parquet(path)
        write_partitioned(incremental_delta(staging, known), path, "sourcesystemdate", "append")
        return spark.read.schema(TARGET).parquet(path).count()

    assert run() == 9
    assert run() == 9


def test_overwrite_replaces_every_partition(spark, tmp_path):
    path = str(tmp_path / "dimension")
    frame = spark.createDataFrame([(1, "a"), (2, "b")], "id int, sourcesystem string")
    write_partitioned(frame, path, "sourcesystem", "overwrite")
    write_partitioned(frame.where("id = 1"), path, "sourcesystem", "overwrite")
    assert rows(spark.read.parquet(path)) == Counter({(1, "a"): 1})


def test_audit_row_is_written_with_the_data(spark, tmp_path):
    data, tracker = str(tmp_path / "data"), str(tmp_path / "tracker")
    frame = target(spark, NOON, NOON + timedelta(days=1), NOON - timedelta(days=1))
    written = write_with_audit(frame, data, "sourcesystemdate", tracker, "flat", today=date(2020, 1, 1))
    expected = ingestion_audit(frame, "flat", today=date(2020, 1, 1))
    stored = spark.read.parquet(tracker)
    assert rows(written) == rows(stored) == rows(expected)
    assert rows(stored) == Counter({("flat", 3, NOON + timedelta(days=1), date(2020, 1, 1)): 1})
    assert spark.read.parquet(data).count() == 3

    write_with_audit(frame.where("false"), data, "sourcesystemdate", tracker, "flat")
    start = F.lit("2018-08-01").cast("timestamp")
    read = spark.read.parquet(tracker)
    assert last_ingested(read, "flat", start).first()[0] == NOON + timedelta(days=1)
    assert last_ingested(read, "other", start).first()[0] == datetime(2018, 8, 1)


def test_stream_takes_each_file_once(spark, tmp_path):
    staging, path, marks = (str(tmp_path / name) for name in ("staging", "target", "marks"))
    target_schema = spark.createDataFrame([], TARGET).schema
    spark.createDataFrame([], TARGET).write.partitionBy("sourcesystemdate").parquet(path)

    def arrive(*hours):
        records = [(str(hour), NOON + timedelta(hours=hour), NOON, "I") for hour in hours]
        staged(spark, *records).coalesce(1).write.mode("append").parquet(staging)

    def ingest():
        query = ingest_new_files(
            spark, staging, spark.createDataFrame([], STAGING).schema, path, target_schema, marks
        )
        query.awaitTermination()
        taken = sum(progress["numInputRows"] for progress in query.recentProgress)
        return spark.read.schema(target_schema).parquet(path).count(), taken

    arrive(1, 2)
    assert ingest()[0] == 2
    arrive(3)
    assert ingest()[0] == 3
    assert ingest() == (3, 0)


@pytest.fixture
def arrivals(spark, tmp_path):
    """Functions to drop staging files and to ingest them into a target of the name given."""
    schema = spark.createDataFrame([], STAGING).schema
    target_schema = spark.createDataFrame([], TARGET).schema

    def arrive(staging, *records):
        staged(spark, *[(chid, at, NOON, "I") for chid, at in records]).coalesce(1).write.mode(
            "append"
        ).parquet(str(tmp_path / staging))

    def ingest(staging, name, **options):
        path = str(tmp_path / name)
        ingest_new_files(
            spark, str(tmp_path / staging), schema, path, target_schema,
            str(tmp_path / f"marks-{name}"), **options,
        )
        return spark.read.schema(target_schema).parquet(path)

    return arrive, ingest


@pytest.mark.parametrize("days", [(20, 10, 15), (10, 15, 20)])
def test_batch_size_and_file_order_decide_no_row(spark, arrivals, days):
    arrive, ingest = arrivals
    for day in days:
        arrive("staging", (f"m{day}", datetime(2019, 1, day, 12)), ("twice", datetime(2019, 1, 9)))
    every = rows(ingest("staging", "all"))
    assert rows(ingest("staging", "one", files_per_batch=1)) == every
    assert {row[0] for row in every} == {"m10", "m15", "m20", "twice"} and set(every.values()) == {1}


def test_repeated_batch_completes_a_half_written_one(spark, arrivals, monkeypatch):
    arrive, ingest = arrivals
    arrive("staging", ("old", datetime(2019, 1, 1)))
    ingest("staging", "target", files_per_batch=1)
    arrive("staging", ("late", datetime(2019, 1, 20)), ("early", datetime(2019, 1, 10)))
    arrive("staging", ("other", datetime(2019, 1, 5)))

    def half(df, path, partition, mode):
        write_partitioned(df.where("chid = 'late'"), path, partition, mode)
        raise OSError("lost half way")

    with monkeypatch.context() as broken, pytest.raises(Exception, match="lost half way"):
        broken.setattr("haulmark.streaming.delta_stream.write_partitioned", half)
        ingest("staging", "target", files_per_batch=1)
    found = ingest("staging", "target", files_per_batch=1)
    assert Counter(row["chid"] for row in found.collect()) == Counter(["old", "late", "early", "other"])
    # the next run has its own watermark: what is older than the target is late
    arrive("staging", ("too late", datetime(2019, 1, 12)), ("new", datetime(2019, 1, 21)))
    found = ingest("staging", "target")
    assert {row["chid"] for row in found.collect()} == {"old", "late", "early", "other", "new"}


def test_stream_ignores_future_partitions_when_guarded(spark, arrivals):
    arrive, ingest = arrivals
    arrive("staging", ("future", datetime(2999, 1, 1)))
    ingest("staging", "target")
    arrive("staging", ("now", NOON))
    assert ingest("staging", "target", today=date(2019, 6, 2)).count() == 2
