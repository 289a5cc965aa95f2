"""Calendar expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def month_of(day: Column) -> Column:
    return F.trunc(day, "month")


def week_of(day: Column) -> Column:
    """Monday of the ISO week."""
    return F.trunc(day, "week")


def week_ending(day: Column) -> Column:
    """Sunday of the ISO week."""
    return F.date_add(week_of(day), 6)


def fiscal_quarter(day: Column) -> Column:
    """``2024Q1``."""
    return F.concat(F.year(day).cast("string"), F.lit("Q"), F.quarter(day).cast("string"))


def parse_day(raw: Column, pattern: str) -> Column:
    """Strict date in a given format; anything else is NULL."""
    return F.try_to_timestamp(raw, F.lit(pattern)).cast("date")


def month_from_text(raw: Column) -> Column:
    """``2024-03`` -> first day of that month."""
    return F.to_date(F.concat(raw, F.lit("-01")))


def calendar_columns(day: Column) -> dict[str, Column]:
    """The attributes of the date dimension."""
    return {
        "year": F.year(day),
        "quarter": F.quarter(day),
        "month": F.month(day),
        "month_name": F.date_format(day, "MMM"),
        "month_start": month_of(day),
        "week_start": week_of(day),
        "iso_week": F.weekofyear(day),
        "day_of_week": F.dayofweek(day),
        "year_quarter": F.concat(F.year(day).cast("string"), F.lit("-Q"), F.quarter(day).cast("string")),
    }
