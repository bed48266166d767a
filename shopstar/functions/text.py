"""Text cleaning expressions. `trim` removes blanks only; tabs are data."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# The placeholder for missing text and the street prefix.
MISSING = "N/A"
STREET_PREFIX = "ul."


def is_blank(text: Column) -> Column:
    """True for NULL and for text of blanks only."""
    return text.isNull() | (F.trim(text) == "")


def _capitalise(text: Column) -> Column:
    return F.concat(F.upper(F.left(text, F.lit(1))), F.lower(F.substr(text, F.lit(2))))


def sentence_case(text: Column) -> Column:
    """Trimmed, first letter upper, everything after it lower (not per word)."""
    return _capitalise(F.trim(text))


def or_default(text: Column, default: str = MISSING) -> Column:
    """NULL becomes the default; an empty string stays empty."""
    return F.coalesce(text, F.lit(default))


def street_line(street: Column, ignore_case: bool = False) -> Column:
    """One leading street prefix, however many the raw text carries."""
    prefix = F.lit(STREET_PREFIX)
    if ignore_case:
        without = F.regexp_replace(F.trim(street), F.lit("(?i)" + re.escape(STREET_PREFIX)), F.lit(""))
    else:
        without = F.replace(F.trim(street), prefix, F.lit(""))
    line = F.trim(F.concat(prefix, F.lit(" "), _capitalise(F.ltrim(without))))
    return F.when(is_blank(street), F.lit(MISSING)).otherwise(line)
