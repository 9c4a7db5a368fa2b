"""Appends that a lost driver, a repetition or a second run cannot double: a ledger of runs.

Below the target lies the hidden folder `_runs`. A run takes the next free number, writes its rows to a
place of its own there and then commits: it creates the ledger entry of its number, which only one
attempt can. The winner's files are moved into the target, its tracker row is put beside them, and the
run is marked as done. What stops before the commit leaves the target as it was; what stops
behind it is carried on by the next run before that looks for its watermark. So data and tracker
row become one unit, and two runs from one watermark leave its rows once.

Readers meanwhile see the files moved so far, as with any commit of a Spark write. The store must be able
to create a name that is not there yet in one step (HDFS and its like, local disks). The driver handles
names of files only.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass
from datetime import date
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

RUNS = "_runs"


@dataclass(frozen=True)
class Run:
    """A committed run: its number, rows, newest event time (as in the ledger) and the partitions it wrote."""

    number: int
    attempt: str
    rows: int
    newest: int | str | None
    kind: str
    partition: str
    values: tuple[str, ...]
    tracker: str | None = None
    source: str | None = None
    day: str | None = None

    def newest_time(self) -> Column:
        """The newest event time as a typed literal."""
        if self.kind == "timestamp":
            return F.timestamp_micros(F.lit(self.newest).cast("long"))
        return F.lit(self.newest).cast(self.kind)

    def tracker_row(self, spark: SparkSession) -> DataFrame:
        return spark.range(1).select(
            F.lit(self.source).alias("source_name"),
            F.lit(self.rows).cast("long").alias("ingested_row_count"),
            self.newest_time().alias("rovertimestamp"),
            F.lit(self.day).cast("date").alias("ingestiontimestamp"),
        )


class _Ledger:
    """The folder of runs of one target."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")
        self.fs = self._at(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    def _at(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(name)

    def name(self, *parts: str) -> str:
        return "/".join([self.path, RUNS, *parts])

    def names(self) -> list[str]:
        folder = self._at(self.name())
        return sorted(s.getPath().getName() for s in self.fs.listStatus(folder)) if self.fs.exists(folder) else []

    def exists(self, name: str) -> bool:
        return self.fs.exists(self._at(name))

    def files(self, place: str) -> list[str]:
        """Data files below a place, relative to it."""
        if not self.exists(place):
            return []
        root = self.fs.makeQualified(self._at(place)).toString()
        found, each = [], self.fs.listFiles(self._at(place), True)
        while each.hasNext():
            name = each.next().getPath().toString().removeprefix(root).lstrip("/")
            if not name.rsplit("/", 1)[-1].startswith(("_", ".")):
                found.append(name)
        return sorted(found)

    def move(self, source: str, target: str) -> None:
        """Moves a file; nothing happens if another run that carries on has moved it before."""
        self.fs.mkdirs(self._at(target).getParent())
        moved = self.exists(source) and self.fs.rename(self._at(source), self._at(target))
        if not moved and not self.exists(target):
            raise OSError(f"{source} could not be moved to {target}")

    def delete(self, name: str) -> None:
        self.fs.delete(self._at(name), True)

    def create(self, name: str, text: str) -> bool:
        """Creates a small file with its content at once; False if the name is taken."""
        hadoop = self.spark._jvm.org.apache.hadoop.fs
        draft = f"{name}.{uuid.uuid4().hex}"
        out = self.fs.create(self._at(draft), True)
        out.write(bytearray(text.encode()))
        out.close()
        kind = getattr(hadoop, "Options$Rename")
        options = self.spark.sparkContext._gateway.new_array(kind, 1)
        options[0] = kind.NONE
        context = hadoop.FileContext.getFileContext(self._at(name).toUri(), self.spark._jsc.hadoopConfiguration())
        try:
            context.rename(self._at(draft), self._at(name), options)
        except Exception:
            if not self.exists(name):
                raise
            self.delete(draft)
            return False
        return True

    def read(self, name: str) -> str:
        stream = self.fs.open(self._at(name))
        try:
            return self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()


def _publish(ledger: _Ledger, run: Run) -> None:
    """Moves the files of a committed run into the target and its tracker row beside them; may be repeated."""
    place = ledger.name(f"{run.number:012d}-{run.attempt}")
    for name in ledger.files(place):
        ledger.move(f"{place}/{name}", f"{ledger.path}/{name}")
    if run.tracker is not None:
        row = f"{run.tracker}/run-{run.attempt}.parquet"
        if not ledger.exists(row):
            draft = ledger.name(f"{run.number:012d}-{run.attempt}-tracker-{uuid.uuid4().hex}")
            run.tracker_row(ledger.spark).coalesce(1).write.parquet(draft)
            [file] = ledger.files(draft)
            ledger.move(f"{draft}/{file}", row)
            ledger.delete(draft)
    ledger.create(ledger.name(f"{run.number:012d}.done"), "")
    ledger.delete(place)


def _committed(ledger: _Ledger, number: int) -> Run:
    record = json.loads(ledger.read(ledger.name(f"{number:012d}.json")))
    return Run(**record | {"values": tuple(record["values"])})


def recover(spark: SparkSession, path: str) -> int:
    """Carries on what earlier runs of the target at `path` left, and returns the number of the next run.

    Places of attempts that lost their number are removed.
    """
    ledger = _Ledger(spark, path)
    names = ledger.names()
    numbers = [int(n.removesuffix(".json")) for n in names if n.endswith(".json")]
    if not numbers:
        return 0
    last = max(numbers)
    if f"{last:012d}.done" not in names:
        _publish(ledger, _committed(ledger, last))
    for name in names:
        if "-" in name and int(name.split("-")[0]) < last:
            ledger.delete(ledger.name(name))
    return last + 1


def last_run(spark: SparkSession, path: str) -> Run | None:
    """The last committed run of the target at `path`."""
    ledger = _Ledger(spark, path)
    numbers = [int(n.removesuffix(".json")) for n in ledger.names() if n.endswith(".json")]
    return _committed(ledger, max(numbers)) if numbers else None


def append_run(
    spark: SparkSession,
    path: str,
    rows: Callable[[], DataFrame],
    partition: str,
    *,
    time: str | None = None,
    tracker: str | None = None,
    source: str | None = None,
    today: date | None = None,
) -> Run:
    """Append what `rows` gives to the Parquet table at `path` by `partition`, as one run of its ledger.

    `rows` is called after earlier runs are carried on, so it finds a whole target and tracker. With
    `tracker` the run adds its row there: `source`, count, newest `time` and day. Both are observed in the
    writing tasks themselves, after the last shuffle, so a lost executor cannot count a row twice.

    If another attempt has committed this number meanwhile, the rows here are dropped, for both started from the
    same watermark, and the other's run is returned.
    """
    number = recover(spark, path)
    ledger = _Ledger(spark, path)
    df, attempt = rows(), uuid.uuid4().hex
    place = ledger.name(f"{number:012d}-{attempt}")
    kind = df.schema[time].dataType if time else T.StringType()
    newest = F.max(time) if time else F.lit(None).cast("string")
    seen = Observation(f"run {number} {attempt}")
    shown = F.unix_micros(newest) if isinstance(kind, T.TimestampType) else newest.cast("string")
    rebalanced = df.hint("rebalance", partition).observe(seen, F.count(F.lit(1)).alias("rows"), shown.alias("newest"))
    rebalanced.write.partitionBy(partition).parquet(place)
    result = seen.get
    if today is None and tracker is not None:
        today = spark.range(1).select(F.current_date()).first()[0]
    folders = {name.rsplit("/", 1)[0] for name in ledger.files(place) if "/" in name}
    record = {
        "number": number, "attempt": attempt, "rows": result["rows"], "newest": result["newest"], "kind": kind.simpleString(),
        "partition": partition, "values": sorted(unquote(f.split("=", 1)[1]) for f in folders),
        "tracker": tracker and tracker.rstrip("/"), "source": source, "day": today and today.isoformat(),
    }
    if not ledger.create(ledger.name(f"{number:012d}.json"), json.dumps(record)):
        ledger.delete(place)
    run = _committed(ledger, number)
    if not ledger.exists(ledger.name(f"{number:012d}.done")):
        _publish(ledger, run)
    return run
