"""Tolerant typing and calendar functions on hand-made values, ANSI mode on."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.functions import calendar, typing


def _apply(spark, values, function, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(function(F.col("v"))).collect()]


def test_ansi_mode_is_on(spark):
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"


def test_flag_or_null(spark):
    words = [" Yes ", "y", "TRUE", "t", "1", "no", "N", "false", "F", " 0", "maybe", "", None]
    want = [True] * 5 + [False] * 5 + [None] * 3
    assert _apply(spark, words, typing.flag_or_null) == want


def test_flag_or_false(spark):
    words = ["true", "T", "1", "y", "Yes", "false", "0", "maybe", "", None]
    want = [True] * 5 + [False] * 5
    assert _apply(spark, words, typing.flag_or_false) == want


def test_amount(spark):
    texts = ["1,234.5", "1,234,567", "999", "-1,0", "", "(S)", "-", None]
    want = [1234.5, 1234567.0, 999.0, -10.0, None, None, None, None]
    assert _apply(spark, texts, typing.amount) == want


def test_integer_and_number(spark):
    assert _apply(spark, ["1", "x", "", None], typing.integer) == [1, None, None, None]
    assert _apply(spark, ["1.5", "-", "", None], typing.number) == [1.5, None, None, None]


def test_utf8(spark):
    text = "Zürich €"
    assert _apply(spark, [bytearray(text, "utf-8")], typing.utf8, "binary") == [text]


def test_year_month_to_date(spark):
    texts = ["2024-01", "2024-12", "2024/02", "2024", "2024-Q1", "2024-13", "2024-1", "", None]
    want = [dt.date(2024, 1, 1), dt.date(2024, 12, 1), dt.date(2024, 2, 1)] + [None] * 6
    assert _apply(spark, texts, calendar.year_month_to_date) == want


def test_period_to_month(spark):
    codes = ["M01", "M12", "M13", "Q01", "S01", "A01", "MXX", "M", "", None]
    want = [1, 12, 13] + [None] * 7
    assert _apply(spark, codes, calendar.period_to_month) == want


@pytest.mark.parametrize(
    "year, month, want",
    [
        (2024, 2, dt.date(2024, 2, 1)),
        (2024, 13, None),
        (2024, 0, None),
        (2024, None, None),
        (None, 1, None),
        (2147483647, 1, None),
    ],
)
def test_first_of_month(spark, year, month, want):
    df = spark.createDataFrame([(year, month)], "y int, m int")
    got = df.select(calendar.first_of_month(F.col("y"), F.col("m"))).first()[0]
    assert got == want


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_instants_do_not_depend_on_the_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        texts = ["2024-01-01T10:00:00.123456+00:00", "2024-01-01T12:00:00+02:00", "nope", None]
        read = _apply(spark, texts, lambda c: calendar.utc_wall_clock(calendar.instant(c)))
        assert read == [
            dt.datetime(2024, 1, 1, 10, 0, 0, 123456),
            dt.datetime(2024, 1, 1, 10, 0, 0),
            None,
            None,
        ]
        again = _apply(
            spark,
            texts[:2],
            lambda c: calendar.iso_text(calendar.utc_wall_clock(calendar.instant(c))),
        )
        assert again == ["2024-01-01T10:00:00.123456+00:00", "2024-01-01T10:00:00.000000+00:00"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_calendar_text(spark):
    days = [dt.date(2024, 1, 31), dt.date(2023, 12, 1)]
    assert _apply(spark, days, calendar.month_abbr, "date") == ["Jan", "Dec"]
    assert _apply(spark, days, calendar.year_month_text, "date") == ["2024-01", "2023-12"]
