"""Money and ratio expressions on exact decimals."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY_TYPE = "decimal(18,2)"


def money(amount: Column) -> Column:
    return amount.cast(MONEY_TYPE)


def magnitude(amount: Column) -> Column:
    """Absolute amount, NULL counted as zero, kept in the money type."""
    return F.coalesce(F.abs(amount), F.lit(0)).cast(MONEY_TYPE)


def percent_of(amount: Column, rate: Column) -> Column:
    """Amount times a two-decimal rate, rounded half up to cents."""
    return F.round(money(amount) * rate.cast("decimal(4,2)"), 2).cast(MONEY_TYPE)


def ratio(part: Column, whole: Column, scale: int = 1) -> Column:
    """part / whole * scale to two decimals; NULL when whole is zero.

    Rounded as a decimal: binary doubles put values such as 0.285 on either side.
    """
    exact = (part * scale).cast("decimal(24,6)") / F.nullif(whole, F.lit(0)).cast("decimal(20,0)")
    return F.round(exact, 2).cast("double")
