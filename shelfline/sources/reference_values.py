"""Literal lookup tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Region of each country.
REGION_OF_COUNTRY = {
    "AT": "Central Europe",
    "BE": "Western Europe",
    "CH": "Central Europe",
    "DE": "Central Europe",
    "ES": "Southern Europe",
    "FR": "Western Europe",
    "GB": "Western Europe",
    "IT": "Southern Europe",
    "NL": "Western Europe",
    "PL": "Central Europe",
    "PT": "Southern Europe",
    "SE": "Northern Europe",
}

# Spellings of each country in partner files.
COUNTRY_SPELLINGS = {
    "AT": ("Austria", "Österreich", "AT"),
    "BE": ("Belgium", "Belgique", "BE"),
    "CH": ("Switzerland", "Schweiz", "CH", "Suisse"),
    "DE": ("Germany", "Deutschland", "DE", "GER"),
    "ES": ("Spain", "España", "ES", "Espana"),
    "FR": ("France", "FR", "FRA"),
    "GB": ("United Kingdom", "UK", "GB", "Great Britain"),
    "IT": ("Italy", "Italia", "IT"),
    "NL": ("Netherlands", "Nederland", "NL", "Holland"),
    "PL": ("Poland", "Polska", "PL", "POL"),
    "PT": ("Portugal", "PT"),
    "SE": ("Sweden", "Sverige", "SE"),
}


def region_map(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(REGION_OF_COUNTRY.items()), "country_code string, region string")


def alias_map(spark: SparkSession) -> DataFrame:
    """One row per upper-cased spelling."""
    rows = [(name.upper(), code) for code, names in COUNTRY_SPELLINGS.items() for name in names]
    return spark.createDataFrame(rows, "alias string, country_code string")
