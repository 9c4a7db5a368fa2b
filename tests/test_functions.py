from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from haulmark.functions.text import (
    EXCLUDED_NAME_PARTS,
    MAKE_SPELLINGS,
    excludes_all,
    make_model_key,
    normalize_make,
    not_null_text,
)
from haulmark.functions.timeops import (
    days_between,
    epoch_second,
    local_time,
    parse_date,
    safe_rate,
    year_month,
)


def values(df):
    return [tuple(row) for row in df.collect()]


def texts(spark, *rows):
    return spark.createDataFrame([(row,) for row in rows], "t string")


def times(spark, kind, *rows):
    return texts(spark, *rows).select(F.col("t").cast(kind).alias("t"))


def test_names_are_excluded_by_case_sensitive_parts(spark):
    df = texts(spark, "CRANE BAAT", "crane group", "PRE-TRIP X", "RTG 12", None, "MISCELLANEOUS")
    assert values(df.where(excludes_all("t"))) == [("crane group",), ("RTG 12",)]
    for part in EXCLUDED_NAME_PARTS:
        assert values(texts(spark, f"x{part}y").where(excludes_all("t"))) == []


def test_no_parts_exclude_only_missing_names(spark):
    assert values(texts(spark, "GROUP", None).where(excludes_all("t", ()))) == [("GROUP",)]


def test_null_marker_is_dropped_like_null(spark):
    df = texts(spark, "NULL", None, "null", "x")
    assert values(df.where(not_null_text("t"))) == [("null",), ("x",)]


@pytest.mark.parametrize(
    ("written", "make"),
    [
        (" \tTerex/Noell\n", "terex"),
        ("terex/noell x", "terex/noell x"),
        ("Treberg", "terberg"),
        ("CHEVY", "chevrolet"),
        ("Caterpillar ", "caterpillar"),
        (None, None),
    ],
)
def test_makes_are_cleaned_and_recoded(spark, written, make):
    assert values(texts(spark, written).select(normalize_make("t"))) == [(make,)]


def test_recoding_order_cannot_matter():
    for spelling, make in MAKE_SPELLINGS.items():
        assert MAKE_SPELLINGS.get(make, make) == make, spelling


def test_model_key_is_null_when_either_is(spark):
    df = spark.createDataFrame([("a", "b"), ("a", None), (None, "b")], "m string, n string")
    assert values(df.select(make_model_key("m", "n"))) == [("a-b",), (None,), (None,)]


LOCAL = [
    ("2019-03-10 07:30:00", datetime(2019, 3, 10, 3, 30)),
    ("2019-11-03 05:30:00", datetime(2019, 11, 3, 1, 30)),
    ("2019-11-03 06:30:00", datetime(2019, 11, 3, 1, 30)),
    ("2020-05-02 03:30:00", datetime(2020, 5, 1, 23, 30)),
]


@pytest.mark.parametrize(("utc", "local"), LOCAL)
@pytest.mark.parametrize("kind", ["timestamp_ntz", "timestamp"])
def test_local_time_follows_daylight_saving(spark, utc, local, kind):
    df = times(spark, kind, utc)
    shown = df.select(local_time(df, "t").cast("string"))
    assert values(shown) == [(str(local),)]


@pytest.mark.parametrize(("utc", "local"), LOCAL)
def test_local_time_of_plain_timestamps_ignores_the_session_zone(spark, utc, local):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = times(spark, "timestamp_ntz", utc)
        assert values(df.select(local_time(df, "t"))) == [(local,)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_year_month_pads_and_defaults(spark):
    df = times(spark, "timestamp", "2019-01-31 10:00:00", "2019-11-01 00:00:00", None)
    assert values(df.select(year_month("t"))) == [("201901",), ("201911",), ("190001",)]


def test_days_between_counts_real_days_and_fractions(spark):
    df = spark.createDataFrame([(date(2019, 1, 5), date(2019, 3, 10))], "a date, b date")
    assert values(df.select(days_between("a", "b"))) == [(64.0,)]
    df = times(spark, "timestamp_ntz", "2019-01-01 12:00:00").withColumn(
        "z", F.lit("2019-01-03").cast("timestamp_ntz")
    )
    assert values(df.select(days_between("t", "z"))) == [(1.5,)]


def test_rate_over_zero_is_null(spark):
    df = spark.createDataFrame([(4.0, 2.0), (4.0, 0.0), (None, 2.0)], "a double, b double")
    assert values(df.select(safe_rate("a", "b"))) == [(2.0,), (None,), (None,)]


def test_short_dates_parse_with_their_century(spark):
    df = texts(spark, "3/5/19", "03/05/19", "12/31/68", "1/1/69", "2/29/00", "bad", "13/1/19", None)
    assert [row[0] for row in values(df.select(parse_date("t")))] == [
        date(2019, 3, 5), date(2019, 3, 5), date(2068, 12, 31), date(1969, 1, 1),
        date(2000, 2, 29), None, None, None,
    ]


def test_epoch_second_never_decreases_and_agrees_between_types(spark):
    rows = ["1969-12-31 23:59:59.5", "1970-01-01 00:00:00", "2024-03-10 02:30:00.999999"]
    plain, zoned = times(spark, "timestamp_ntz", *rows), times(spark, "timestamp", *rows)
    found = [row[0] for row in values(plain.select(epoch_second(plain, "t")))]
    assert found == [-1, 0, 1710037800]
    assert found == [row[0] for row in values(zoned.select(epoch_second(zoned, "t")))]
