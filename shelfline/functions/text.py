"""Cleaning of partner text: identifiers, numbers, units, barcodes, masking."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unit spellings in partner files.
UNIT_SPELLINGS = ("EA", "PCS", "UNITS")
CASE_SPELLINGS = ("CS", "CASES", "CSE")


def partner_id(raw: Column) -> Column:
    """``c-000751`` -> ``C000751``."""
    return F.upper(F.replace(F.trim(raw), F.lit("-"), F.lit("")))


def barcode(raw: Column) -> Column:
    """Barcode without blanks."""
    return F.replace(F.trim(raw), F.lit(" "), F.lit(""))


def looks_scientific(code: Column) -> Column:
    """A spreadsheet turned the barcode into ``7.60901E+12``."""
    return F.contains(F.upper(code), F.lit("E+"))


def plain_number(raw: Column) -> Column:
    return raw.try_cast("double")


def dotted_thousands(raw: Column) -> Column:
    """``1.234`` is one thousand two hundred and thirty-four; a decimal comma is not a number."""
    return F.replace(raw, F.lit("."), F.lit("")).try_cast("double")


def comma_decimal(raw: Column) -> Column:
    return F.replace(raw, F.lit(","), F.lit(".")).try_cast("double")


def unit_of_measure(raw: Column) -> Column:
    spelled = F.upper(F.trim(raw))
    return F.when(spelled.isin(*UNIT_SPELLINGS), "units").when(spelled.isin(*CASE_SPELLINGS), "cases")


def alias_key(raw: Column) -> Column:
    """Lookup key of a country spelling."""
    return F.upper(F.trim(raw))


def ean13_check_digit(body: Column) -> Column:
    """Check digit of the first twelve digits: weights 1 and 3 from the left."""
    odd = sum((F.substring(body, i, 1).cast("int") for i in range(1, 13, 2)), F.lit(0))
    even = sum((F.substring(body, i, 1).cast("int") for i in range(2, 13, 2)), F.lit(0))
    return F.pmod(F.lit(10) - F.pmod(odd + even * 3, F.lit(10)), F.lit(10)).cast("int")


def ean13_valid(code: Column) -> Column:
    """13 digits whose last one is the check digit; never NULL."""
    digits = F.when(code.rlike("^[0-9]{13}$"), code)
    return F.coalesce(ean13_check_digit(digits) == F.substring(digits, 13, 1).cast("int"), F.lit(False))


def masked(value: Column) -> Column:
    """First character and three stars; NULL stays NULL."""
    return F.concat(F.left(value, F.lit(1)), F.lit("***"))
