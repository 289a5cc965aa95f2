"""Row filter and column mask as secured views."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline.functions.text import masked
from shelfline.sources.tables import updated

ALL_COUNTRIES = "ALL"


def grants_of(access: DataFrame, user: str) -> DataFrame:
    """What a user may see, one row: everything, or a set of country codes (never more than there are
    countries)."""
    mine = access.filter(F.col("user_email") == user)
    return mine.agg(
        F.coalesce(F.bool_or(F.col("country_code") == ALL_COUNTRIES), F.lit(False)).alias("_all"),
        F.collect_set("country_code").alias("_countries"),
    )


def row_filter(df: DataFrame, access: DataFrame, user: str, country: str = "country_code") -> DataFrame:
    """Rows of the countries a user may see.  The grants are one row, so the fact is only scanned."""
    allowed = F.col("_all") | F.array_contains("_countries", F.col(country))
    return df.join(F.broadcast(grants_of(access, user)), allowed).drop("_all", "_countries")


def mask_columns(df: DataFrame, columns: Sequence[str], readers: DataFrame, user: str) -> DataFrame:
    """Contact columns in full for a listed reader, else first character and stars."""
    reader = readers.agg(F.coalesce(F.bool_or(F.col("user_email") == user), F.lit(False)).alias("_reader"))
    hidden = {c: F.when(F.col("_reader"), F.col(c)).otherwise(masked(F.col(c))) for c in columns}
    return df.join(F.broadcast(reader)).withColumns(hidden).drop("_reader")


def secured_view(spark: SparkSession, name: str, df: DataFrame, access: DataFrame, user: str | None = None) -> None:
    """A view that shows each session only its rows; without a user the session's own user counts."""
    row_filter(df, access, user or current_user(spark)).createOrReplaceTempView(name)


def current_user(spark: SparkSession) -> str:
    return spark.sql("SELECT current_user() AS u").first()["u"]


def grant(access: DataFrame, user: str, country: str) -> DataFrame:
    """Access table after a change: the user's rows get the country, a new user gets a row."""
    changed = updated(access, F.col("user_email") == user, {"country_code": F.lit(country)}).distinct()
    known = access.filter(F.col("user_email") == user).select("user_email").distinct()
    newcomer = access.sparkSession.createDataFrame([(user, country)], "user_email string, country_code string")
    return changed.unionByName(newcomer.join(known, "user_email", "left_anti"))


def visibility(df: DataFrame, amount: str, country: str = "country_code") -> DataFrame:
    """Countries and sales visible under the filter."""
    return df.agg(
        F.countDistinct(country).alias("countries_visible"),
        F.round(F.sum(F.col(amount).cast("decimal(24,2)")).cast("double") / 1e6, 1).alias("net_sales_eur_m"),
        F.min(country).alias("first_country"),
    )


def register_functions(spark: SparkSession) -> None:
    """The mask and the access rule as SQL functions of the session."""
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION mask_text(value STRING, is_reader BOOLEAN) RETURNS STRING "
        "RETURN CASE WHEN is_reader THEN value ELSE concat(left(value, 1), '***') END"
    )
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION may_see(country STRING, granted STRING) RETURNS BOOLEAN "
        f"RETURN granted = '{ALL_COUNTRIES}' OR granted = country"
    )


# rules in SQL ------------------------------------------------------------------------------------------------------------

#: Session variable that names the user whose rules count; the session's own user unless it is set.
ACTING = "acting_user"


def install_rules(spark: SparkSession, access: DataFrame, readers: DataFrame) -> None:
    """The access rule and the mask as SQL functions over their tables, for use in any view of the session.

    ``user_may_see(country)`` asks the access table for a row of the user that grants everything or this country; the
    second question is correlated, so Spark plans it as a semi join on the country.  ``shown_to_user(value)`` asks
    the list of readers."""
    access.createOrReplaceTempView("country_access")
    readers.createOrReplaceTempView("pii_readers")
    spark.sql(f"DECLARE OR REPLACE VARIABLE {ACTING} STRING DEFAULT current_user()")
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION user_may_see(country STRING) RETURNS BOOLEAN RETURN "
        f"EXISTS (SELECT 1 FROM country_access WHERE user_email = session.{ACTING} AND country_code = '{ALL_COUNTRIES}') "
        f"OR EXISTS (SELECT 1 FROM country_access a WHERE a.user_email = session.{ACTING} AND a.country_code = country)"
    )
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION shown_to_user(value STRING) RETURNS STRING RETURN "
        f"CASE WHEN EXISTS (SELECT 1 FROM pii_readers WHERE user_email = session.{ACTING}) THEN value "
        "ELSE concat(left(value, 1), '***') END"
    )


def act_as(spark: SparkSession, user: str | None = None) -> None:
    """Whose rules count from here on; None: those of the session's own user."""
    if user is None:
        spark.sql(f"SET VAR {ACTING} = current_user()")
    else:
        spark.sql(f"SET VAR {ACTING} = :user", args={"user": user})


def secured_sql_view(spark: SparkSession, name: str, source: str, country: str | None = None, masked_columns: Sequence[str] = ()) -> None:
    """A view over a table or view: only the user's countries, contact columns masked.  It is resolved anew by every
    query, so it follows ``act_as`` and changes of the access table."""
    columns = [f"shown_to_user(`{c}`) AS `{c}`" if c in masked_columns else f"`{c}`" for c in spark.table(source).columns]
    rule = f" WHERE user_may_see(`{country}`)" if country else ""
    spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW {name} AS SELECT {', '.join(columns)} FROM {source}{rule}")
