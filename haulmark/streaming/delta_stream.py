"""Incremental ingestion driven by newly arrived staging files."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from haulmark.plans.incremental import HISTORY_START, fresh_rows, newest_date, newest_time
from haulmark.sources.sinks import write_partitioned
from haulmark.sources.tables import path_exists

RUN, DATE, TIME, FINISHED = "run", "newest_date", "newest_time", "finished"


def _open_run(
    spark: SparkSession, path: str, target: DataFrame, event_time: str, partition: str,
    default: date, today: Column | date | None,
) -> DataFrame:
    """The one-row watermark of this run, from the table of runs at `path`.

    A run that did not finish is carried on with its own watermark; else a new one is taken
    from the target.
    """
    kind = target.schema[event_time].dataType.simpleString()
    schema = f"{RUN} bigint, {DATE} date, {TIME} {kind}, {FINISHED} boolean"
    last = None
    if path_exists(spark, path):
        runs = spark.read.schema(schema).parquet(path)
        last = runs.groupBy(RUN).agg(F.max(FINISHED).alias(FINISHED)).orderBy(F.desc(RUN)).first()
    if last is None or last[FINISHED]:
        newest = newest_date(target, partition, default, today)
        latest = newest_time(target, partition, event_time, newest, default)
        number = 0 if last is None else last[RUN] + 1
        row = newest.select(
            F.lit(number).cast("bigint").alias(RUN), F.col(partition).alias(DATE),
            latest.scalar().alias(TIME), F.lit(False).alias(FINISHED),
        )
        row.coalesce(1).write.mode("append").parquet(path)
    else:
        number = last[RUN]
    return spark.read.schema(schema).parquet(path).where((F.col(RUN) == number) & ~F.col(FINISHED))


def ingest_new_files(
    spark: SparkSession,
    staging_path: str,
    staging_schema: T.StructType,
    target_path: str,
    target_schema: T.StructType,
    checkpoint_path: str,
    *,
    event_time: str = "rovertimestamp",
    partition: str = "sourcesystemdate",
    default: date = HISTORY_START,
    today: Column | date | None = None,
    files_per_batch: int | None = None,
    **options,
) -> StreamingQuery:
    """Take every staging file not seen before through `incremental_delta` into the target.

    Runs until all files there at the start are taken, and returns the ended query. The
    checkpoint remembers the files, so a run without new files adds nothing. The watermark is
    taken once, before the first batch, and kept in `<checkpoint_path>-runs`; every batch of the
    run and every repetition of one after a failure uses it, so `files_per_batch` and the order
    of the files decide nothing. As in the batch form, rows not newer than the target was when the
    run began are late and left out.

    A batch adds the rows that the target does not have yet, found among those newer than the
    watermark. So duplicates in different batches are taken once, and a batch repeated over
    the half of it that a failed attempt had moved in place adds the other half.
    `options` go to `fresh_rows`.
    """
    runs_path = f"{checkpoint_path.rstrip('/')}-runs"

    def target() -> DataFrame:
        if not path_exists(spark, target_path):
            return spark.createDataFrame([], target_schema)
        return spark.read.schema(target_schema).parquet(target_path)

    run = _open_run(spark, runs_path, target(), event_time, partition, default, today)
    newest, latest = run.select(DATE), run.select(TIME)

    reader = spark.readStream.schema(staging_schema)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)

    def append(batch: DataFrame, batch_id: int) -> None:
        fresh = fresh_rows(
            batch, newest.scalar(), latest.scalar(),
            event_time=event_time, partition=partition, **options,
        )
        known = target().where(
            (F.col(partition) >= newest.scalar()) & (F.col(event_time) > latest.scalar())
        ).toDF(*[f"_known_{name}" for name in target_schema.names])
        same = [F.col(name).eqNullSafe(F.col(f"_known_{name}")) for name in target_schema.names]
        added = fresh.join(known, reduce(Column.__and__, same), "left_anti")
        write_partitioned(added, target_path, partition, "append")

    query = (
        reader.parquet(staging_path)
        .writeStream.foreachBatch(append)
        .option("checkpointLocation", checkpoint_path)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    done = run.withColumn(FINISHED, F.lit(True))
    done.coalesce(1).write.mode("append").parquet(runs_path)
    return query
