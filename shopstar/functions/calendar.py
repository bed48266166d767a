"""Date and time expressions on zone-less timestamps."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

SECONDS_PER_DAY = 86_400

# Upper year bound of each marketing band; beyond the last (or no
# birth date) is the closing band.
AGE_BANDS = ((17, "Under 18"), (24, "18-24"), (34, "25-34"), (44, "35-44"), (54, "45-54"))
CLOSING_AGE_BAND = "55+"


def timestamp_lit(moment: datetime | date | str) -> Column:
    """Zone-less timestamp literal, independent of Python and session time zones."""
    text = moment if isinstance(moment, str) else moment.isoformat()
    return F.lit(text).cast("timestamp_ntz")


def date_key(moment: Column) -> Column:
    """yyyyMMdd as an integer; NULL stays NULL."""
    return F.year(moment) * 10_000 + F.month(moment) * 100 + F.dayofmonth(moment)


def time_key(moment: Column) -> Column:
    """HHmm as an integer: 08:05 is 805."""
    return F.hour(moment) * 100 + F.minute(moment)


def us_week(day: Column) -> Column:
    """Week number with weeks starting on Sunday and 1 January in week 1."""
    leading = F.dayofweek(F.trunc(day, "YEAR")) - 1
    return (F.floor((F.dayofyear(day) - 1 + leading) / 7) + 1).cast("int")


def _second_of_day(moment: Column) -> Column:
    return F.hour(moment) * 3600 + F.minute(moment) * 60 + F.second(moment)


def seconds_between(start: Column, end: Column) -> Column:
    """Second boundaries crossed from start to end (fractions are cut off first)."""
    days = F.datediff(end, start).cast("bigint")
    return days * SECONDS_PER_DAY + _second_of_day(end) - _second_of_day(start)


def _year_gap(birth: Column, today: Column) -> Column:
    return F.year(today) - F.year(birth)


def age(birth: Column, today: Column) -> Column:
    """Completed years of life."""
    month_day = lambda d: F.month(d) * 100 + F.dayofmonth(d)
    not_yet = F.when(month_day(birth) > month_day(today), 1).otherwise(0)
    return _year_gap(birth, today) - not_yet


def age_band(birth: Column, today: Column) -> Column:
    """Band by difference of calendar years, not by completed age."""
    years = _year_gap(birth, today)
    band = None
    for upper, label in AGE_BANDS:
        fits = years <= upper
        band = F.when(fits, label) if band is None else band.when(fits, label)
    return band.otherwise(CLOSING_AGE_BAND)
