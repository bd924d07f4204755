"""Column helpers shared by the models.  All stay inside generated code."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def clean(name: str) -> Column:
    return F.trim(F.col(name))


def clean_upper(name: str) -> Column:
    return F.upper(F.trim(F.col(name)))


def clean_lower(name: str) -> Column:
    return F.lower(F.trim(F.col(name)))


def flag(condition: Column) -> Column:
    """True where the condition holds, false where it fails or is unknown."""
    return F.coalesce(condition, F.lit(False))


def days_between(start, end) -> Column:
    return F.datediff(end, start)


def or_zero(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0))


def decimal_pct(part: Column, whole: Column) -> Column:
    """``part / whole`` in percent with two decimals, for decimal operands.

    The quotient is first rounded to eight decimals, the scale a fixed-point
    warehouse division keeps for two-decimal operands.
    """
    return F.round(F.round(part / whole, 8) * 100, 2).cast("decimal(18,2)")


def half_up(value: Column, digits: int) -> Column:
    """Round a double half away from zero with plain IEEE steps."""
    scale = float(10**digits)
    return F.signum(value) * F.floor(F.abs(value) * scale + 0.5) / scale


def mean(value) -> Column:
    """Average as a double, from an exact sum."""
    return F.sum(value).cast("double") / F.count(value)


def cents_mean(value) -> Column:
    """``mean`` of decimals that ``cents_sum`` takes."""
    return cents_sum(value, "decimal(28,2)").cast("double") / F.count(value)


def count_where(condition: Column) -> Column:
    return F.count(F.when(condition, F.lit(1)))


def sum_where(condition: Column, value) -> Column:
    """Sum of the values where the condition holds, 0 where none does."""
    value = F.col(value) if isinstance(value, str) else value
    return F.sum(F.when(condition, value).otherwise(F.lit(0)))


# Bits of the low part of an amount in cents; 2^33 rows add up without an overflow.
LOW_BITS = 30


def cents_sum(value, kind: str) -> Column:
    """Sum of decimals of two places and at most 18 digits, as the decimal ``kind``; NULL where there are none.

    While it is added up it is two longs, the high and the low part of the cents. Spark keeps the sum of
    a decimal in 32 bytes, and a shuffle of such sums is about twice as large.
    """
    high, low = halves(value)
    return from_halves(F.sum(high), F.sum(low), kind)


def halves(value) -> tuple[Column, Column]:
    """High and low part of the cents of a decimal of two places and at most 18 digits."""
    value = F.col(value) if isinstance(value, str) else value
    cents = (value * 100).cast("bigint")
    return F.shiftright(cents, LOW_BITS), cents.bitwiseAND(F.lit((1 << LOW_BITS) - 1).cast("bigint"))


def from_halves(high: Column, low: Column, kind: str) -> Column:
    """The amount whose parts ``halves`` has told apart, or the sum of such."""
    step = Decimal(1 << LOW_BITS) / 100
    whole = high.cast("decimal(20,0)") * step + low.cast("decimal(20,0)") * Decimal("0.01")
    return whole.cast(kind)


def cents_where(condition: Column, value, kind: str) -> Column:
    """``cents_sum`` of the values where the condition holds, 0 where none does."""
    value = F.col(value) if isinstance(value, str) else value
    return cents_sum(F.when(condition, value).otherwise(F.lit(0)), kind)


def moment(ts: dt.datetime) -> Column:
    """A literal timestamp without time zone."""
    return F.lit(ts.replace(tzinfo=None).isoformat(sep=" ")).cast("timestamp_ntz")


def first_rows(df: DataFrame, k: int | None) -> DataFrame:
    """The first ``k`` rows of a sorted report, or all of it."""
    return df if k is None else df.limit(k)
