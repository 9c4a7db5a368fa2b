"""Runs stopped between any two steps, repeated, or started twice: every row once, data and tracker alike."""

from __future__ import annotations

from collections import Counter
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from haulmark import schemas
from haulmark.plans import jobs
from haulmark.sources import runs
from haulmark.sources.sinks import add_partitions
from test_jobs import AT, DAY, catalog, expected_flat, flat_rows, rows, telemetry  # noqa: F401


class Lost(Exception):
    """The driver is gone."""


def frame(spark, *records):
    return spark.createDataFrame(
        [(k, AT + timedelta(hours=k), DAY + timedelta(days=d)) for k, d in records],
        "k int, rovertimestamp timestamp, sourcesystemdate date",
    )


def stop_at(monkeypatch, name, after=0):
    """Lets the method of the ledger fail for good, `after` calls from now."""
    calls, plain = [], getattr(runs._Ledger, name)

    def failing(self, *args):
        calls.append(args)
        if len(calls) > after:
            raise Lost
        return plain(self, *args)

    monkeypatch.setattr(runs._Ledger, name, failing)


# before the commit; between commit and files; between files and tracker row; before the mark
@pytest.mark.parametrize(("name", "after"), [("create", 0), ("move", 0), ("move", 1), ("create", 1)])
def test_tracked_run_lost_between_two_steps(spark, catalog, tmp_path, monkeypatch, name, after):
    telemetry(spark, catalog, [0, 13, 30])
    path, tracker = str(tmp_path / "flat"), str(tmp_path / "tracker")
    spark.createDataFrame([], schemas.INGESTION_TRACKER).write.parquet(tracker)
    with monkeypatch.context() as patch:
        stop_at(patch, name, after)
        with pytest.raises(Lost):
            jobs.run_tracked_flat_file(spark, "yard", path, tracker, today=DAY)
    jobs.run_tracked_flat_file(spark, "yard", path, tracker, today=DAY)
    assert flat_rows(spark.read.parquet(path), "lot") == expected_flat([0, 13, 30], "L")
    found = rows(spark.read.parquet(tracker).where("ingested_row_count > 0"))
    assert found == Counter({(jobs.FLAT_FILE, 6, AT + timedelta(hours=30), DAY): 1})


def test_copies_of_a_row_survive_a_lost_run(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    df = frame(spark, (1, 0), (1, 0), (2, 1), (2, 1), (2, 2))
    with monkeypatch.context() as patch:
        stop_at(patch, "move", 1)
        with pytest.raises(Lost):
            runs.append_run(spark, path, lambda: df, "sourcesystemdate")
    assert runs.recover(spark, path) == 1
    assert runs.recover(spark, path) == 1
    assert rows(spark.read.parquet(path).select("k")) == Counter({(1,): 2, (2,): 3})


@pytest.mark.parametrize("table", ["fuel", "position"])
def test_two_runs_from_one_watermark(spark, catalog, table, monkeypatch):
    time = jobs.DELTA_EVENT_TIME[table]
    fields = f"chid string, {time} timestamp"
    stage = spark.createDataFrame(
        [(c, AT + timedelta(days=d), AT, "I") for c, d in (("a", 0), ("b", 1), ("c", 2))],
        f"{fields}, audtdateadded timestamp, dboperationtype string",
    )
    catalog("staging", table, stage)
    empty = spark.createDataFrame([], f"{fields}, sourcesystemtimestamp timestamp, sourcesystemdate date")
    path = catalog("yard", table, empty, "sourcesystemdate")
    plain, started = jobs.incremental_delta, []

    def overtaken(*args, **options):
        """The second run begins and ends while the first holds its watermark."""
        found = plain(*args, **options)
        if not started:
            started.append(1)
            jobs.run_delta(spark, "staging", "yard", table, path)
        return found

    monkeypatch.setattr(jobs, "incremental_delta", overtaken)
    jobs.run_delta(spark, "staging", "yard", table, path)
    assert started
    expected = Counter({("a",): 1, ("b",): 1, ("c",): 1})
    assert rows(spark.table(f"yard.{table}").select("chid")) == expected
    assert rows(spark.read.parquet(path).select("chid")) == expected


def test_delta_lost_before_registering(spark, catalog, monkeypatch):
    """The watermark of the next run counts files that are in place and not registered."""
    stage = spark.createDataFrame(
        [("a", AT, AT, "I")], "chid string, rovertimestamp timestamp, audtdateadded timestamp, dboperationtype string"
    )
    catalog("staging", "fuel", stage)
    empty = spark.createDataFrame(
        [], "chid string, rovertimestamp timestamp, sourcesystemtimestamp timestamp, sourcesystemdate date"
    )
    path = catalog("yard", "fuel", empty, "sourcesystemdate")
    with monkeypatch.context() as patch:
        patch.setattr(runs._Ledger, "create", lambda self, name, text, plain=runs._Ledger.create: plain(self, name, text))
        patch.setattr(jobs, "add_partitions", lambda *args: (_ for _ in ()).throw(Lost()))
        with pytest.raises(Lost):
            jobs.run_delta(spark, "staging", "yard", "fuel", path)
    for _ in range(2):
        jobs.run_delta(spark, "staging", "yard", "fuel", path)
        assert rows(spark.table("yard.fuel").select("chid")) == Counter({("a",): 1})


def test_only_written_partitions_are_registered(spark, catalog):
    path = catalog("yard", "days", frame(spark, (0, 0)), "sourcesystemdate")
    frame(spark, (7, 7)).write.mode("append").partitionBy("sourcesystemdate").parquet(path)  # not of the run
    blank = frame(spark, (2, 2)).withColumn("sourcesystemdate", F.lit(None).cast("date"))
    run = runs.append_run(spark, path, lambda: frame(spark, (0, 0), (1, 1)).union(blank), "sourcesystemdate")
    add_partitions(spark, "yard", "days", run.partition, run.values)
    found = spark.table("yard.days").select("k", "sourcesystemdate")
    assert rows(found) == Counter({(0, DAY): 2, (1, DAY + timedelta(days=1)): 1, (2, None): 1})
    assert run.rows == 3 and len(spark.sql("SHOW PARTITIONS yard.days").collect()) == 3


def test_a_run_without_rows_and_the_newest_time_of_each_kind(spark, tmp_path):
    tracker = str(tmp_path / "tracker")
    for kind, at in (("timestamp", AT), ("timestamp_ntz", datetime(2019, 3, 31, 2, 30)), ("date", date(2019, 6, 1))):
        path = str(tmp_path / kind)
        df = spark.createDataFrame([(at, DAY)], f"t {kind}, sourcesystemdate date")
        options = {"time": "t", "tracker": f"{tracker}-{kind}", "source": "s", "today": DAY}
        assert runs.append_run(spark, path, lambda df=df: df.limit(0), "sourcesystemdate", **options).rows == 0
        run = runs.append_run(spark, path, lambda df=df: df, "sourcesystemdate", **options)
        assert run.number == 1 and run.tracker_row(spark).first()["rovertimestamp"] == at
        found = spark.read.parquet(f"{tracker}-{kind}")
        assert rows(found) == Counter({("s", 0, None, DAY): 1, ("s", 1, at, DAY): 1})
