"""The jobs end to end: catalog tables in, partitioned Parquet and registered partitions out."""

from __future__ import annotations

from collections import Counter
from datetime import date, datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F, types as T

from haulmark import schemas
from haulmark.plans import jobs, refresh
from haulmark.sources.sinks import write_csv, write_rejects
from haulmark.sources.tables import catalog_table, checked_csv, csv_table, parquet_table, table_name

AT = datetime(2019, 6, 1, 12)
DAY = date(2019, 6, 1)


def rows(df):
    return Counter(tuple(row) for row in df.collect())


def filled(schema, **given):
    """One row of `schema`: the given values, else None."""
    return tuple(given.get(field.name) for field in schema)


@pytest.fixture
def catalog(spark, tmp_path):
    for database in ("staging", "yard"):
        spark.sql(f"CREATE DATABASE {database}")

    def create(database, table, frame, partition=None):
        path = str(tmp_path / database / table)
        writer = frame.write.partitionBy(partition) if partition else frame.write
        writer.parquet(path)
        columns = ", ".join(f"`{name}` {kind}" for name, kind in frame.dtypes)
        layout = f"PARTITIONED BY ({partition})" if partition else ""
        spark.sql(
            f"CREATE TABLE {database}.{table} ({columns}) USING parquet {layout} LOCATION '{path}'"
        )
        if partition:
            spark.sql(f"MSCK REPAIR TABLE {database}.{table}")
        return path

    yield create
    for database in ("staging", "yard"):
        spark.sql(f"DROP DATABASE {database} CASCADE")


def test_only_plain_identifiers_become_table_names():
    assert table_name("yard", "fuel") == "yard.fuel"
    for bad in ("yard; DROP TABLE x", "a.b", "", "a b"):
        with pytest.raises(ValueError):
            table_name(bad, "fuel")


@pytest.mark.parametrize("table", sorted(jobs.DELTA_EVENT_TIME))
def test_delta_job_appends_new_rows_once(spark, catalog, table):
    time = jobs.DELTA_EVENT_TIME[table]
    fields = f"chid string, {time} timestamp"
    stage = spark.createDataFrame(
        [("a", AT, AT, "I"), ("b", AT + timedelta(hours=1), AT, "I"), ("c", AT, AT, "D"),
         ("b", AT + timedelta(hours=1), AT + timedelta(hours=2), "U")],
        f"{fields}, audtdateadded timestamp, dboperationtype string",
    )
    catalog("staging", table, stage)
    empty = spark.createDataFrame(
        [], f"{fields}, sourcesystemtimestamp timestamp, sourcesystemdate date"
    )
    path = catalog("yard", table, empty, "sourcesystemdate")
    for _ in range(2):
        jobs.run_delta(spark, "staging", "yard", table, path)
        found = spark.table(f"yard.{table}").select("chid", time, "sourcesystemdate")
        assert rows(found) == Counter({("a", AT, DAY): 1, ("b", AT + timedelta(hours=1), DAY): 1})


@pytest.mark.parametrize("table", [*sorted(refresh.DIMENSIONS), "roverdetails", "vehicledetails"])
def test_refresh_job_replaces_the_table(spark, catalog, table):
    if table in refresh.DIMENSIONS:
        names, partition = ["sourcesystem", *refresh.DIMENSIONS[table]], "sourcesystem"
    else:
        names = refresh.ROVER_COLUMNS if table == "roverdetails" else refresh.VEHICLE_COLUMNS
        partition = "yrmon"
    kinds = {name: "timestamp" if name.endswith("timestamp") else "string" for name in names}
    kinds |= {name: "int" for name in ("vehiclesubtypeid",) if name in kinds}
    value = {"timestamp": AT, "string": "x", "int": 3}
    record = tuple(value[kinds[name]] for name in names)
    stage = spark.createDataFrame(
        [(*record, AT, "I"), (*record, AT + timedelta(days=1), "U"), (*record, AT, "D")],
        ", ".join(f"`{name}` {kind}" for name, kind in kinds.items())
        + ", audtdateadded timestamp, dboperationtype string",
    )
    catalog("staging", table, stage)
    old = {
        "sourcesystem": refresh.dimension, "yrmon": lambda df, _: refresh.vehicle_details(df)
        if table == "vehicledetails" else refresh.rover_details(df),
    }[partition](stage, table)
    path = catalog("yard", table, old.withColumn(partition, F.lit("old")), partition)
    jobs.run_refresh(spark, "staging", "yard", table, path)
    found = spark.read.parquet(path)
    assert found.count() == 1
    assert found.where(F.col(partition).cast("string") == "old").count() == 0
    if partition == "sourcesystem":
        assert found.first()["audtdateadded"] == AT + timedelta(days=1)
    else:
        assert str(found.first()["yrmon"]) == "201906"
    assert spark.table(f"yard.{table}").where(F.col(partition) != "old").count() == 1


def telemetry(spark, catalog, hours):
    """Machine m/c with one position per hour, and readings just inside and outside their reach."""
    machine = {"mjid": "m", "chid": "c", "sourcesystemdate": DAY}
    spots = [AT + timedelta(hours=hour) for hour in hours]

    def load(name, schema, records):
        frame = spark.createDataFrame([filled(schema, **record) for record in records], schema)
        catalog("yard", name, frame, "sourcesystemdate" if "sourcesystemdate" in frame.columns else None)

    position = [
        {**machine, "rovertimestamp": at, "latchtypeid": 1, "vehicletypeid": 2, "lot": "L"}
        for at in spots
    ] + [{**machine, "rovertimestamp": AT, "latchtypeid": 9, "vehicletypeid": 2}]
    load("position", schemas.POSITION, position)
    load("positionenh", schemas.POSITION_ENHANCED, position)
    load("latch", schemas.LATCH, [
        {**machine, "rovertimestamp": at - timedelta(seconds=s), "flags": s} for at in spots for s in (1, 2)
    ])
    load("fuel", schemas.FUEL, [
        {**machine, "rovertimestamp": at - timedelta(seconds=s), "level1": float(s)}
        for at in spots for s in (0, 301, 302)
    ])
    load("impact", schemas.IMPACT, [{**machine, "mjid": "other", "rovertimestamp": AT}])
    tire = T.StructType([
        *schemas.FUEL.fields[1:3], T.StructField("servertimestamp", T.TimestampType()),
        T.StructField("sourcesystemtimestamp", T.TimestampType()), T.StructField("lot", T.StringType()),
        T.StructField("sourcesystem", T.StringType()), T.StructField("pressure", T.DoubleType()),
        T.StructField("sourcesystemdate", T.DateType()),
    ])
    load("tireenh", tire, [
        {**machine, "rovertimestamp": at - timedelta(seconds=60), "pressure": 7.5} for at in spots
    ])
    for name, key in (("latchtype", 1), ("vehicletype", 2)):
        frame = spark.createDataFrame([(key, f"{name} {key}")], f"{name}id int, description string")
        catalog("yard", name, frame)


def flat_rows(df, *extra):
    return rows(df.select("rovertimestamp", "spreaderstate", "vehicletype", "latchflags", "fuellevel1",
                          "impactflags", *extra))


def expected_flat(hours, *extra):
    return Counter(
        {
            (AT + timedelta(hours=hour), "latchtype 1", "vehicletype 2", 1, level, None, *extra): 1
            for hour in hours for level in (0.0, 301.0)
        }
    )


def test_rebuilt_flat_file(spark, catalog, tmp_path):
    telemetry(spark, catalog, [0, 1])
    path = str(tmp_path / "flat")
    for _ in range(2):
        jobs.rebuild_flat_file(spark, "yard", path)
    found = spark.read.parquet(path)
    assert flat_rows(found) == expected_flat([0, 1])
    assert "lot" not in found.columns
    jobs.rebuild_flat_file(spark, "yard", path, start=date(2019, 6, 2))
    assert spark.read.schema(found.schema).parquet(path).count() == 0


def test_flat_file_follows_its_own_watermark(spark, catalog):
    telemetry(spark, catalog, [0, 1, 2])
    table = lambda name: catalog_table(spark, "yard", name)
    lookbacks = jobs.telemetry.reading_lookbacks(
        table("latch"), table("fuel"), table("impact"), table("tireenh")
    )
    first = jobs.telemetry.flat_file(
        table("positionenh").where(F.col("rovertimestamp") <= AT + timedelta(hours=1)),
        table("latchtype"), table("vehicletype"), lookbacks,
    )
    path = catalog("yard", jobs.FLAT_FILE, first, "sourcesystemdate")
    for _ in range(2):
        jobs.run_flat_file(spark, "yard", path)
        found = spark.table(f"yard.{jobs.FLAT_FILE}")
        # The readings before the watermark still reach the first new position.
        assert flat_rows(found, "lot", "pressure") == expected_flat([0, 1, 2], "L", 7.5)


def test_tracked_flat_file_records_each_run(spark, catalog, tmp_path):
    telemetry(spark, catalog, [0, 1])
    path, tracker = str(tmp_path / "flat"), str(tmp_path / "tracker")
    spark.createDataFrame([], schemas.INGESTION_TRACKER).write.parquet(tracker)
    for _ in range(2):
        jobs.run_tracked_flat_file(spark, "yard", path, tracker, today=DAY)
    assert flat_rows(spark.read.parquet(path), "lot") == expected_flat([0, 1], "L")
    assert rows(spark.read.parquet(tracker)) == Counter(
        {(jobs.FLAT_FILE, 4, AT + timedelta(hours=1), DAY): 1, (jobs.FLAT_FILE, 0, None, DAY): 1}
    )


def test_reports_are_written(spark, catalog, tmp_path):
    tables = {
        "operationalasset": (schemas.OPERATIONAL_ASSET, [(1, "RTG 1", "crane", date(2010, 1, 1), 1, 10)]),
        "lookuptable": (
            schemas.LOOKUP_TABLE,
            [(10, "CRANE", "7", "crane"), (20, "c", "0", "tire"), (30, "MAKE", "0", ""),
             (31, "MODEL NO", "0", "")],
        ),
        "operationalview": (schemas.OPERATIONAL_VIEW, [(1, "NORTH")]),
        "worktype": (schemas.WORK_TYPE, [(100, "FAIL", "Failure")]),
        "workorder": (schemas.WORK_ORDER, [(20, 1, 100, date(2019, 1, 5), None)]),
        "meter": (
            schemas.METER,
            [(1, date(2019, 1, day), date(2019, 1, 1), "m", "Hour Meter") for day in (1, 9)],
        ),
        "task": (schemas.TASK, [(1, 1, 30)]),
        "tableattribute": (schemas.TABLE_ATTRIBUTE, [(1, 30, "noell"), (1, 31, "x")]),
    }
    for name, (schema, data) in tables.items():
        catalog("yard", name, spark.createDataFrame(data, schema))
    out = str(tmp_path / "reports")
    for _ in range(2):
        jobs.run_reports(spark, "yard", out)
    orders = spark.read.parquet(f"{out}/_orders")
    for name, report in jobs.maintenance_reports(spark, "yard", orders).items():
        assert not any("/yard/workorder/" in file for file in report.inputFiles()), name
        plain = jobs.maintenance_reports(spark, "yard")[name]
        assert rows(report) == rows(plain), name
    counts = {
        name: spark.read.parquet(f"{out}/{name}").count()
        for name in jobs.maintenance_reports(spark, "yard") if name != "timeline_listing"
    }
    assert counts == {
        "timeline": 1, "failures_by_make_model": 1, "usage_vs_failures": 1, "fault_causes": 1,
        "usage_rate": 1, "survival": 2, "survival_by_make_site": 2,
    }
    listing = spark.read.csv(f"{out}/timeline_listing", header=True)
    assert listing.first()["type"] == "Failure"


def test_csv_round_trip_with_unparseable_dates(spark, tmp_path):
    path = str(tmp_path / "csv")
    text = spark.createDataFrame(
        [("1", "3/5/19"), ("2", "bad"), ("3", None)], "operationalassetid string, raisedate string"
    )
    write_csv(text, path, separator=",")
    schema = T.StructType(
        [T.StructField("operationalassetid", T.IntegerType()), T.StructField("raisedate", T.DateType())]
    )
    assert rows(csv_table(spark, path, schema)) == Counter(
        {(1, date(2019, 3, 5)): 1, (2, None): 1, (3, None): 1}
    )


def test_rejected_csv_rows_are_kept_apart(spark, tmp_path):
    path, rejects = str(tmp_path / "orders.csv"), str(tmp_path / "rejects")
    lines = ["id,hours,day", "1,2.5,3/5/19", "x,1.0,3/6/19", "2,,bad", "3,many,3/7/19", "4,1.0", "5,1.0,3/8/19,more", ",,"]
    (tmp_path / "orders.csv").write_text("\n".join(lines) + "\n")
    schema = T.StructType([
        T.StructField("id", T.IntegerType()), T.StructField("hours", T.DoubleType()), T.StructField("day", T.DateType()),
    ])
    good, bad = checked_csv(spark, path, schema)
    assert rows(good) == Counter({(1, 2.5, date(2019, 3, 5)): 1, (2, None, None): 1, (None, None, None): 1})
    assert good.select("day").count() == 3  # whatever is selected
    for n in (1, 2):
        assert write_rejects(bad, rejects) == 4
        found = spark.read.parquet(rejects)
        assert rows(found.select("rejected_row")) == Counter({(line,): n for line in (lines[2], lines[4], lines[5], lines[6])})
        assert all(r["file"].endswith("orders.csv") for r in found.collect())
    assert csv_table(spark, path, schema).count() == 7


def test_csv_report_in_one_file(spark, tmp_path):
    df = spark.range(100).repartition(5)
    write_csv(df, str(tmp_path / "one"), one_file=True)
    assert len(list((tmp_path / "one").glob("*.csv"))) == 1
    assert spark.read.csv(str(tmp_path / "one"), header=True).count() == 100


def test_delta_opens_no_file_of_an_older_partition(spark, catalog):
    kinds = "chid string, rovertimestamp timestamp"
    stage = [(c, AT + timedelta(days=d), AT, "I") for c, d in (("a", 0), ("b", 1), ("c", 3))]
    catalog("staging", "fuel", spark.createDataFrame(stage, f"{kinds}, audtdateadded timestamp, dboperationtype string"))
    known = [("a", AT, AT, DAY), ("b", AT + timedelta(days=1), AT, DAY + timedelta(days=1))]
    known = spark.createDataFrame(known, f"{kinds}, sourcesystemtimestamp timestamp, sourcesystemdate date")
    path = catalog("yard", "fuel", known, "sourcesystemdate")
    spark.sql(f"ALTER TABLE yard.fuel ADD PARTITION (sourcesystemdate = '{DAY + timedelta(days=2)}')")  # empty
    for file in Path(path, f"sourcesystemdate={DAY}").glob("*.parquet"):
        file.write_bytes(b"no Parquet")
    jobs.run_delta(spark, "staging", "yard", "fuel", path)
    found = spark.table("yard.fuel").where(F.col("sourcesystemdate") > F.lit(DAY))
    assert rows(found.select("chid")) == Counter({("b",): 1, ("c",): 1})


def test_parquet_table_projects_and_renames(spark, tmp_path):
    path = str(tmp_path / "fuel")
    spark.createDataFrame([(1, 2.0)], "a int, level1 double").write.parquet(path)
    found = parquet_table(spark, path, {"fuellevel1": "level1"})
    assert found.columns == ["fuellevel1"] and rows(found) == Counter({(2.0,): 1})
