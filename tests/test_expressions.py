"""Column expressions on boundary values."""

from __future__ import annotations

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from shopstar import functions as fn


def values(spark, rows, ddl, column):
    frame = spark.createDataFrame(rows, ddl)
    return [r[0] for r in frame.select(column).collect()]


def test_sentence_case(spark):
    texts = ["  anna MARIA ", "ŻANETA", "x", "", None, "\tab"]
    got = values(spark, [(t,) for t in texts], "t STRING", fn.sentence_case(F.col("t")))
    assert got == ["Anna maria", "Żaneta", "X", "", None, "\tab"]


def test_blank_is_null_or_blanks_but_not_a_tab(spark):
    texts = [None, "", "  ", "\t", "a"]
    got = values(spark, [(t,) for t in texts], "t STRING", fn.is_blank(F.col("t")))
    assert got == [True, True, True, False, False]


@pytest.mark.parametrize(
    "raw, clean",
    [
        ("ul.  Krzywe Kolo 7", "ul. Krzywe kolo 7"),
        (" ul. Jasna 12", "ul. Jasna 12"),
        ("Cicha 5 ", "ul. Cicha 5"),
        ("ul. ul. ŁĄKOWA", "ul. Łąkowa"),
        ("UL. Nowa", "ul. Ul. nowa"),
        ("ul.", "ul."),
        ("   ", "N/A"),
        (None, "N/A"),
    ],
)
def test_street_line(spark, raw, clean):
    assert values(spark, [(raw,)], "s STRING", fn.street_line(F.col("s"))) == [clean]


def test_date_and_time_keys(spark):
    moments = [datetime(2024, 3, 5, 8, 5), datetime(2030, 12, 31, 23, 59, 59), None]
    rows = [(m,) for m in moments]
    assert values(spark, rows, "m TIMESTAMP_NTZ", fn.date_key(F.col("m"))) == [
        20240305, 20301231, None,
    ]
    assert values(spark, rows, "m TIMESTAMP_NTZ", fn.time_key(F.col("m"))) == [805, 2359, None]


def test_us_week_counts_sundays(spark):
    days = [date(2020, 1, 1) + timedelta(n) for n in range(366 * 11)]

    def expected(day):
        first = date(day.year, 1, 1)
        sundays = sum((first + timedelta(n)).weekday() == 6 for n in range(1, (day - first).days + 1))
        return 1 + sundays

    got = values(spark, [(d,) for d in days], "d DATE", fn.us_week(F.col("d")))
    assert got == [expected(d) for d in days]


def test_seconds_between_counts_boundaries(spark):
    at = datetime(2024, 1, 1, 10, 0, 0)
    pairs = [
        (at + timedelta(milliseconds=900), at + timedelta(seconds=1, milliseconds=100), 1),
        (at, at + timedelta(milliseconds=999), 0),
        (at, at + timedelta(days=1, seconds=1), 86_401),
        (None, at, None),
    ]
    got = values(
        spark,
        [p[:2] for p in pairs],
        "a TIMESTAMP_NTZ, b TIMESTAMP_NTZ",
        fn.seconds_between(F.col("a"), F.col("b")),
    )
    assert got == [p[2] for p in pairs]


def test_age_and_band(spark):
    today = F.lit("2025-06-15").cast("date")
    births = [date(2007, 6, 16), date(2007, 6, 15), date(2001, 12, 31), date(1990, 1, 1),
              date(1971, 6, 1), date(1970, 6, 15), None]
    rows = [(b,) for b in births]
    assert values(spark, rows, "b DATE", fn.age(F.col("b"), today)) == [17, 18, 23, 35, 54, 55, None]
    # The band goes by calendar years: 17 years of age can already be 18-24.
    assert values(spark, rows, "b DATE", fn.age_band(F.col("b"), today)) == [
        "18-24", "18-24", "18-24", "35-44", "45-54", "55+", "55+",
    ]


def test_ratio_rounds_half_up_and_guards_zero(spark):
    rows = [(285, 1000), (1, 3), (0, 5), (5, 0)]
    ratio = fn.ratio(F.col("a"), F.col("b"))
    assert values(spark, rows, "a BIGINT, b BIGINT", ratio) == [0.29, 0.33, 0.0, None]
    percent = fn.ratio(F.col("a"), F.col("b"), scale=100)
    assert values(spark, rows, "a BIGINT, b BIGINT", percent) == [28.5, 33.33, 0.0, None]
