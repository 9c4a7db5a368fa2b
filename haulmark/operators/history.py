"""Cumulative counts and gaps along the time of a key.

A window over a key would sort the key's whole history in one task. The forms below first
sum rows per key and instant, in every task before the shuffle, then run windows over groups
of bounded length only: days of a key, seconds of a day, instants of a second.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from haulmark.functions.timeops import SECONDS_PER_DAY, epoch_second
from haulmark.operators.skew import row_hash


def _running(value: str, groups: Sequence[str], order: str) -> Column:
    window = Window.partitionBy(*groups).orderBy(order)
    return F.sum(value).over(window.rowsBetween(Window.unboundedPreceding, Window.currentRow))


def running_total(instants: DataFrame, keys: Sequence[str], time: str, value: str) -> DataFrame:
    """Running sum of `value` along `time` per key, one row per key and time."""
    if isinstance(instants.schema[time].dataType, T.DateType):
        days = instants.groupBy(*keys, time).agg(F.sum(value).alias(value))
        return days.withColumn(value, _running(value, keys, time))

    # All three levels carry the same columns and filters, so each is shuffled once and its
    # shuffle used by the level above and by the join below.
    rows = instants.withColumn("_second", epoch_second(instants, time)).withColumn(
        "_day", F.floor(F.col("_second") / SECONDS_PER_DAY)
    )
    rows = rows.where(F.col("_second").isNotNull() & F.col("_day").isNotNull())
    rows = rows.groupBy(*keys, "_day", "_second", time).agg(F.sum(value).alias(value))
    seconds = rows.groupBy(*keys, "_day", "_second").agg(F.sum(value).alias("_in_second"))
    days = seconds.groupBy(*keys, "_day").agg(F.sum("_in_second").alias("_in_day"))
    days = days.select(
        *keys, "_day", (_running("_in_day", keys, "_day") - F.col("_in_day")).alias("_before_day")
    )
    before_second = _running("_in_second", [*keys, "_day"], "_second") - F.col("_in_second")
    seconds = (
        seconds.withColumn("_before_second", before_second)
        .join(days, [*keys, "_day"])
        .select(
            *keys, "_day", "_second",
            (F.col("_before_day") + F.col("_before_second")).alias("_before"),
        )
    )
    return (
        rows.withColumn(value, _running(value, [*keys, "_day", "_second"], time))
        .join(seconds, [*keys, "_day", "_second"])
        .select(*keys, time, (F.col(value) + F.col("_before")).alias(value))
    )


def cumulative_count(
    events: DataFrame,
    counted: DataFrame,
    keys: Sequence[str],
    event_time: str,
    counted_time: str,
    name: str,
) -> DataFrame:
    """Per event, the rows of `counted` with the same keys at or before the event's time.

    Rows without a time are not counted, and an event without a time or key counts none.
    """
    asked = events.select(*keys, F.col(event_time).alias(event_time), F.lit(0).alias(name))
    added = counted.select(*keys, F.col(counted_time).alias(event_time), F.lit(1).alias(name))
    instants = asked.unionByName(added).na.drop(subset=[*keys, event_time])
    totals = running_total(instants, keys, event_time, name)
    return _left_of(events, totals, [*keys, event_time]).select(
        *events.columns, F.coalesce(F.col(name), F.lit(0)).alias(name)
    )


def _left_of(events: DataFrame, totals: DataFrame, on: Sequence[str]) -> DataFrame:
    """Left join; events without one of the columns find nothing and are spread by their hash."""
    missing = reduce(Column.__or__, [F.col(name).isNull() for name in on])
    spread = events.withColumn("_spread", F.when(missing, row_hash(events)).otherwise(0))
    return spread.join(totals.withColumn("_spread", F.lit(0).cast("bigint")), [*on, "_spread"], "left")


def since_previous(
    events: DataFrame, key: str, day: str, order: str, start: Column, previous: str, gap: str
) -> DataFrame:
    """Per event, the date of the key's event before it and the days in between.

    `day` is a date and `order` a unique column that ranks the events of one day. The first
    event of a key looks back to `start`; the second of a day looks back to the same day.
    An event without a key or day has no previous one.
    """
    dated = events.where(F.col(key).isNotNull() & F.col(day).isNotNull())
    days = dated.groupBy(key, day).agg(F.min(order).alias("_first"))
    window = Window.partitionBy(key).orderBy(day)
    days = days.withColumn("_earlier", F.coalesce(F.lag(day).over(window), start))
    opens_day = F.col(order) == F.col("_first")
    return (
        _left_of(events, days, [key, day])
        .withColumn(
            previous, F.when(opens_day, F.col("_earlier")).when(~opens_day, F.col(day))
        )
        .withColumn(gap, F.date_diff(F.col(day), F.col(previous)))
        .select(*events.columns, previous, gap)
    )

