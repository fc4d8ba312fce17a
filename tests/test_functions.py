"""Scalar functions where engines commonly disagree."""

from __future__ import annotations

import math
from datetime import date, datetime

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from osspulse import functions as fn


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def ts(text):
    return F.lit(text).cast("timestamp_ntz")


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_hours_count_boundaries(spark, kind):
    def hours(a, b):
        return one(spark, fn.hour_diff(F.lit(a).cast(kind), F.lit(b).cast(kind)))

    assert hours("2024-01-01 10:59:00", "2024-01-01 11:01:00") == 1
    assert hours("2024-01-01 10:00:00", "2024-01-01 10:59:59") == 0
    assert hours("2024-01-02 00:00:00", "2024-01-01 23:59:59") == -1
    assert hours("2024-01-01 00:00:00", "2024-01-05 00:00:00") == 96


def test_month_diff_counts_boundaries(spark):
    assert one(spark, fn.month_diff(ts("2024-01-31"), ts("2024-02-01"))) == 1
    assert one(spark, fn.month_diff(ts("2024-01-01"), ts("2024-01-31"))) == 0
    assert one(spark, fn.month_diff(ts("2024-03-01"), ts("2023-12-31"))) == -3


moments = st.datetimes(datetime(1970, 1, 1), datetime(2100, 1, 1))


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(moments, moments), min_size=50, max_size=50))
def test_differences_equal_duckdb(spark, pairs):
    df = spark.createDataFrame([(str(a), str(b)) for a, b in pairs], "a string, b string")
    df = df.select(F.col("a").cast("timestamp_ntz").alias("a"), F.col("b").cast("timestamp_ntz").alias("b"))
    a, b = F.col("a"), F.col("b")
    ours = df.select(fn.hour_diff(a, b), fn.day_diff(a, b), fn.month_diff(a, b), fn.date_key(a)).collect()
    sql = (
        "select date_diff('hour', ?::timestamp, ?::timestamp), date_diff('day', ?::timestamp, ?::timestamp), "
        "date_diff('month', ?::timestamp, ?::timestamp), strftime(?::timestamp, '%Y%m%d')::int"
    )
    connection = duckdb.connect()
    theirs = [connection.execute(sql, [a, b, a, b, a, b, a]).fetchall()[0] for a, b in pairs]
    assert [tuple(row) for row in ours] == theirs


def test_names_and_numbers_of_days(spark):
    sunday = F.lit(date(2024, 1, 7))
    assert one(spark, fn.day_of_week(sunday)) == 0
    assert one(spark, fn.day_name(sunday)) == "Sunday"
    assert one(spark, fn.month_name(sunday)) == "January"
    assert one(spark, fn.month_label(sunday)) == "2024-01"
    assert one(spark, F.weekofyear(F.lit(date(2024, 12, 30)))) == 1


def test_nulls_stay_null(spark):
    nothing = F.lit(None).cast("timestamp_ntz")
    for column in (
        fn.date_key(nothing),
        fn.hour_diff(nothing, ts("2024-01-01")),
        fn.month_start(nothing),
        fn.clip_unit(F.lit(None)),
    ):
        assert one(spark, column) is None


def test_month_start_has_no_zone(spark):
    df = spark.range(1).select(fn.month_start(ts("2024-05-17 13:00:00")).alias("m"))
    assert df.dtypes == [("m", "timestamp_ntz")]
    assert df.first()["m"] == datetime(2024, 5, 1)


def test_surrogate_key_text(spark):
    import hashlib

    def digest(text):
        return hashlib.md5(text.encode()).hexdigest()

    assert one(spark, fn.surrogate_key(F.lit("a/b"), F.lit(7))) == digest("a/b-7")
    assert one(spark, fn.surrogate_key(F.lit(None), F.lit("x"))) == digest(f"{fn.NULL_KEY_TOKEN}-x")
    assert one(spark, fn.surrogate_key(ts("2024-01-01"))) == digest("2024-01-01 00:00:00")


def test_scores(spark):
    assert one(spark, fn.log_ratio(F.lit(-5), 90)) == 0.0
    assert one(spark, fn.log_ratio(F.lit(90), 90)) == 1.0
    assert one(spark, fn.log_ratio(F.lit(9000), 90)) == 1.0
    assert one(spark, fn.log_ratio(F.lit(10), 90)) == pytest.approx(math.log(11) / math.log(91))
    assert one(spark, fn.half_life_decay(F.lit(180), 180.0)) == 0.5
    assert one(spark, fn.half_life_decay(F.lit(None), 180.0)) == 0.0
    assert one(spark, fn.half_life_decay(F.lit(-180), 180.0)) == 2.0
    assert [one(spark, fn.clip_unit(F.lit(x))) for x in (-1.0, 0.25, 3.0)] == [0.0, 0.25, 1.0]


def test_aware_moments_are_read_in_utc():
    from datetime import timedelta, timezone

    aware = datetime(2024, 1, 1, 1, tzinfo=timezone(timedelta(hours=2)))
    assert fn.utc_naive(aware) == datetime(2023, 12, 31, 23)
