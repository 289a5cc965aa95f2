"""Joins that attach the value valid at a point in time.

No join here forces a broadcast of a table that grows: Spark broadcasts a side when its measured size is
under the session's threshold and otherwise shuffles, splitting skewed partitions (AQE).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.functions.dates import fiscal_quarter
from shelfline.operators.scan import HEAVY_ROWS, HeavyKeys, heavy_keys, ordered_scan, split_heavy
from shelfline.session import pin

#: Keys with more versions than this are matched by one ordered pass instead of a range condition, if their
#: versions do not overlap.  The result is the same either way.
DENSE_VERSIONS = 256


def pit_join(
    facts: DataFrame,
    versions: DataFrame,
    key: str,
    at: Column,
    take: Mapping[str, str],
    dense: int = DENSE_VERSIONS,
    heavy_rows: int = HEAVY_ROWS,
) -> DataFrame:
    """Left join to every version valid at ``at`` (``valid_from <= at < valid_to``); a NULL key or bound never matches.

    ``take`` maps output names to version columns.  A key with few versions is an equi join with a range
    condition.  For a key with many versions that would compare each fact with each version, so where at most one
    version is valid at any time, facts and versions go through one ordered pass together.  Keys whose versions
    overlap may have several matches and stay with the range condition.
    """
    # numbered versions tell with one column whether any key has many
    few = "version" in versions.columns and (versions.agg(F.max("version")).first()[0] or 0) <= dense
    versions = versions.filter(F.col(key).isNotNull() & (F.col("valid_from") < F.col("valid_to")))
    versions = versions.select(key, "valid_from", "valid_to", *[F.col(c).alias(f"_v_{n}") for n, c in take.items()])
    facts = facts.withColumn("_at", at.cast(dict(versions.dtypes)["valid_from"]))
    busy = None if few else _without_overlaps(versions, key, heavy_keys(versions, [key], dense), heavy_rows)
    if busy is None or busy.count == 0:
        return _range_match(facts, versions, key, take)
    busy_facts, calm_facts = split_heavy(facts, busy)
    busy_versions, calm_versions = split_heavy(versions, busy)
    return _range_match(calm_facts, calm_versions, key, take).unionByName(
        _ordered_match(busy_facts, busy_versions, key, take, heavy_rows)
    )


def _without_overlaps(versions: DataFrame, key: str, busy: HeavyKeys, heavy_rows: int) -> HeavyKeys:
    """Those of the busy keys whose versions follow each other."""
    if busy.count == 0:
        return busy
    own = split_heavy(versions, busy)[0].select(key, "valid_from", "valid_to")
    chained = ordered_scan(own, [key], ["valid_from", "valid_to"], upcoming={"_next": F.col("valid_from")}, heavy_rows=heavy_rows)
    crossing = chained.filter(F.col("_next") < F.col("valid_to")).select(key).distinct()
    kept = pin(busy.frame.join(crossing, key, "left_anti"), "busy-keys")
    return HeavyKeys(busy.keys, kept, kept.count(), busy.rows)


def _range_match(facts, versions, key, take) -> DataFrame:
    left, right = facts.alias("_f"), versions.alias("_v")
    valid = (F.col("_f._at") >= F.col("_v.valid_from")) & (F.col("_f._at") < F.col("_v.valid_to"))
    joined = left.join(right, (F.col(f"_f.{key}") == F.col(f"_v.{key}")) & valid, "left")
    kept = [F.col(f"_f.{c}") for c in facts.columns if c != "_at"]
    return joined.select(*kept, *[F.col(f"_v._v_{n}").alias(n) for n in take])


def _ordered_match(facts, versions, key, take, heavy_rows) -> DataFrame:
    fact_columns = [c for c in facts.columns if c != "_at"]
    stream = facts.select(
        key, F.col("_at"), F.lit(1).alias("_kind"), F.struct(*fact_columns).alias("_fact")
    ).unionByName(
        versions.select(
            key,
            F.col("valid_from").alias("_at"),
            F.lit(0).alias("_kind"),
            F.struct("valid_to", *[f"_v_{n}" for n in take]).alias("_version"),
        ),
        allowMissingColumns=True,
    )
    # versions sort before facts of the same instant
    scanned = ordered_scan(stream, [key], ["_at", "_kind"], carry={"_hit": F.col("_version")}, heavy_rows=heavy_rows)
    valid = F.col("_at") < F.col("_hit.valid_to")
    return scanned.filter("_kind = 1").select(
        *[F.col(f"_fact.{c}").alias(c) for c in fact_columns],
        *[F.when(valid, F.col(f"_hit._v_{n}")).alias(n) for n in take],
    )


def asof_join(
    facts: DataFrame,
    series: DataFrame,
    keys: list[str],
    at: str,
    series_at: str,
    take: Mapping[str, str],
    heavy_rows: int = HEAVY_ROWS,
    heavy: HeavyKeys | None = None,
) -> DataFrame:
    """Left join to the newest ``series`` row at or before ``at`` per key, in one ordered pass.  Of several series
    rows at one instant the one with the largest taken values counts; a NULL key or instant never matches.
    ``heavy`` passes a count of the busy keys when a cheaper input than the facts can give it."""
    columns, kinds = facts.columns, dict(series.dtypes)
    known = F.lit(True)
    for k in keys:
        known = known & F.col(k).isNotNull()
    stream = facts.filter(known).select(
        *keys, F.col(at).alias("_at"), F.lit(1).alias("_kind"), F.struct(*columns).alias("_fact")
    ).unionByName(
        series.filter(known & F.col(series_at).isNotNull()).select(
            *keys,
            F.col(series_at).alias("_at"),
            F.lit(0).alias("_kind"),
            F.struct(*[F.col(c).alias(n) for n, c in take.items()]).alias("_value"),
        ),
        allowMissingColumns=True,
    )
    order = ["_at", "_kind", "_value"]
    scanned = ordered_scan(stream, keys, order, carry={"_hit": F.col("_value")}, heavy_rows=heavy_rows, heavy=heavy)
    matched = scanned.filter("_kind = 1").select(
        *[F.col(f"_fact.{c}").alias(c) for c in columns], *[F.col(f"_hit.{n}").alias(n) for n in take]
    )
    keyless = facts.filter(~known).select(*columns, *[F.lit(None).cast(kinds[c]).alias(n) for n, c in take.items()])
    return matched.unionByName(keyless)


def join_fx(df: DataFrame, fx: DataFrame, day: str, currency: str = "currency") -> DataFrame:
    """Rate of the day, left.  The rate table holds one row per currency and calendar day, at most a few
    hundred currencies, so its size is bounded and it is broadcast."""
    rates = fx.select(F.col("currency").alias("_cur"), F.col("rate_date").alias("_day"), "rate_per_eur")
    joined = df.join(F.broadcast(rates), (F.col(currency) == F.col("_cur")) & (F.col(day) == F.col("_day")), "left")
    return joined.drop("_cur", "_day")


def join_standard_cost(df: DataFrame, cost: DataFrame, day: str) -> DataFrame:
    """Standard cost of the quarter of ``day``, left."""
    keyed = df.withColumn("fiscal_quarter", fiscal_quarter(F.col(day)))
    return keyed.join(cost.select("sku", "fiscal_quarter", "std_cost_eur_case"), ["sku", "fiscal_quarter"], "left").drop(
        "fiscal_quarter"
    )


def intervals(df: DataFrame, keys: list[str], start: str, heavy_rows: int = HEAVY_ROWS) -> DataFrame:
    """Half-open intervals: adds ``next_start`` (NULL for the last one)."""
    scanned = ordered_scan(df, keys, [start], upcoming={"_next": F.struct(F.col(start).alias("v"))}, heavy_rows=heavy_rows)
    return scanned.withColumn("next_start", F.col("_next.v")).drop("_next")


def contiguity(df: DataFrame, keys: list[str], heavy_rows: int = HEAVY_ROWS) -> DataFrame:
    """Closed intervals ``[valid_from, valid_to]``: is each one followed by the next day's interval?"""
    chained = intervals(df, keys, "valid_from", heavy_rows)
    return chained.withColumn(
        "is_contiguous",
        F.col("next_start").isNull() | (F.date_add(F.col("valid_to"), 1) == F.col("next_start")),
    )
