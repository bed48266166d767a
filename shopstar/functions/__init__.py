"""Column expressions shared by the layers; all run inside generated code on the JVM."""

from shopstar.functions.calendar import (
    age,
    age_band,
    date_key,
    seconds_between,
    time_key,
    timestamp_lit,
    us_week,
)
from shopstar.functions.money import magnitude, money, percent_of, ratio
from shopstar.functions.text import is_blank, or_default, sentence_case, street_line

__all__ = [
    "age",
    "age_band",
    "date_key",
    "is_blank",
    "magnitude",
    "money",
    "or_default",
    "percent_of",
    "ratio",
    "seconds_between",
    "sentence_case",
    "street_line",
    "time_key",
    "timestamp_lit",
    "us_week",
]
