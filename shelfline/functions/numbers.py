"""Money, rounding and ratio expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(16,2)"
WEIGHT = "decimal(16,3)"


def money(value: Column) -> Column:
    """Round to cents after the arithmetic."""
    return value.cast(MONEY)


def to_base_currency(amount: Column, rate: Column) -> Column:
    """Local amount to the base currency; unknown rate gives NULL."""
    return money(F.try_divide(amount.cast("double"), rate))


def units(value: Column, digits: int) -> Column:
    """A value as a whole number of its smallest unit (cents, grams), rounded half up.  Whole numbers add up
    the same in any order and cost a fraction of wide decimals."""
    return F.floor(value.cast("double") * 10**digits + 0.5)


def unit_sum(value: Column, digits: int) -> Column:
    """Exact sum in smallest units; overflow is an error, never a wrong number."""
    return F.sum(units(value, digits))


def total(value: Column, digits: int = 2, kept: int | None = None) -> Column:
    """Exact sum as double; ``kept`` digits are added up, ``digits`` are shown."""
    kept = digits if kept is None else kept
    summed = unit_sum(value, kept) / 10**kept
    return summed if kept == digits else F.round(summed, digits)


def sum_where(condition: Column, value: Column) -> Column:
    """Sum over the rows that meet a condition; NULL when none does."""
    return F.sum(F.when(condition, value))


def share_of(condition: Column, digits: int = 4) -> Column:
    """Share of rows meeting a condition."""
    return F.round(F.avg(F.when(condition, 1.0).otherwise(0.0)), digits)


def ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient as double, NULL for a zero or missing denominator."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def growth(value: Column, base: Column) -> Column:
    """value / base - 1; blank without a base, -1 when only the base exists."""
    return F.when(base.isNotNull(), ratio(F.coalesce(value.cast("double"), F.lit(0.0)), base) - 1)


def count_where(condition: Column) -> Column:
    """Rows meeting a condition (0 for an empty input)."""
    return F.coalesce(F.count_if(condition), F.lit(0)).cast("long")


def duration_text(seconds: Column) -> Column:
    """``m min ss s``."""
    whole = seconds.cast("long")
    return F.format_string("%d min %02d s", F.floor(whole / 60).cast("long"), F.pmod(whole, F.lit(60)).cast("long"))
