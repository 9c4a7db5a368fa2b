"""Time arithmetic that does not depend on the session time zone."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, functions as F, types as T

# Local zone of the yards, and the date standing for "never".
YARD_ZONE = "America/New_York"
NEVER = date(1900, 1, 1)

SECONDS_PER_DAY = 86400

# Fixed value: last year a two-digit year can stand for.
LAST_SHORT_YEAR = 2068


def _column(column: Column | str) -> Column:
    return F.col(column) if isinstance(column, str) else column


def local_time(df: DataFrame, column: str, zone: str = YARD_ZONE) -> Column:
    """UTC time `column` of `df` as wall-clock time in `zone`, in the column's own type."""
    if isinstance(df.schema[column].dataType, T.TimestampNTZType):
        return F.convert_timezone(F.lit("UTC"), F.lit(zone), F.col(column))
    return F.from_utc_timestamp(F.col(column), zone)


def year_month(column: Column | str, default: date = NEVER) -> Column:
    """`yyyyMM` text; a missing time falls into the month of `default`."""
    return F.date_format(F.coalesce(_column(column), F.lit(default)), "yyyyMM")


def days_between(start: Column | str, end: Column | str) -> Column:
    """Days from `start` to `end` in wall-clock time, with the fraction of a day."""
    seconds = F.timestamp_diff(
        "SECOND",
        _column(start).cast("timestamp_ntz"),
        _column(end).cast("timestamp_ntz"),
    )
    return seconds / F.lit(float(SECONDS_PER_DAY))


def safe_rate(amount: Column | str, base: Column | str) -> Column:
    """Quotient, null over a zero base."""
    return F.try_divide(_column(amount), _column(base))


def parse_date(column: Column | str, pattern: str = "M/d/yy") -> Column:
    """Date from text such as 3/5/19 or 03/05/19; null when it does not parse.

    A two-digit year from 69 on belongs to the last century.
    """
    day = F.try_to_timestamp(_column(column), F.lit(pattern)).cast("date")
    if pattern.count("y") != 2:
        return day
    return F.when(F.year(day) > LAST_SHORT_YEAR, F.add_months(day, -1200)).otherwise(day)


def epoch_second(df: DataFrame, column: str) -> Column:
    """Whole seconds since 1970, never decreasing with time, for both timestamp types."""
    if isinstance(df.schema[column].dataType, T.TimestampType):
        return F.unix_seconds(column)
    return F.expr(
        f"unix_date(CAST(`{column}` AS DATE)) * {SECONDS_PER_DAY}L"
        f" + hour(`{column}`) * 3600 + minute(`{column}`) * 60 + second(`{column}`)"
    )


def seconds_interval(seconds: int) -> Column:
    """Constant day-time interval."""
    return F.make_dt_interval(secs=F.lit(seconds))
