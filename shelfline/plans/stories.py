"""End-to-end plausibility checks on the sales data."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.functions.numbers import ratio
from shelfline.plans.marts import growth_bridge

EXACT = "decimal(24,3)"


def yoy_pivot(mart: DataFrame, key: str, measure: str, years: tuple[int, int]) -> DataFrame:
    """Measure per key with the two years as columns and their growth in percent."""
    first, second = years
    yearly = mart.withColumn("_year", F.year("month_start")).groupBy(key).pivot("_year", list(years))
    pivoted = yearly.agg(F.sum(F.col(measure).cast(EXACT)).cast("double"))
    a, b = F.col(str(first)), F.col(str(second))
    return pivoted.select(
        key, a.alias("first_year"), b.alias("second_year"), F.round(100 * (ratio(b, a) - 1), 1).alias("growth_pct")
    )


def ytd_growth(mart: DataFrame, last_month: int) -> DataFrame:
    """Year-to-date totals and growth: organic, volume, price, reported."""
    bridge = growth_bridge(mart, last_month)
    return bridge.withColumn("reported_pct", F.round(F.col("organic_growth_pct") + F.col("fx_effect_pct"), 1))


def group_corr(df: DataFrame, by: str, x: str, y: str) -> DataFrame:
    """Pearson correlation per group, from exact sums."""
    n = F.count(F.lit(1)).cast("double")
    exact = lambda c: F.sum(c.cast("decimal(30,6)")).cast("double")
    a, b = F.col(x).cast("decimal(15,3)"), F.col(y).cast("decimal(15,3)")
    both = df.filter(F.col(x).isNotNull() & F.col(y).isNotNull())
    sums = both.groupBy(by).agg(
        n.alias("n"), exact(a).alias("sa"), exact(b).alias("sb"), exact(a * a).alias("saa"), exact(b * b).alias("sbb"), exact(a * b).alias("sab")
    )
    c = F.col
    spread = F.sqrt(c("n") * c("saa") - c("sa") * c("sa")) * F.sqrt(c("n") * c("sbb") - c("sb") * c("sb"))
    return sums.select(by, F.round(F.try_divide(c("n") * c("sab") - c("sa") * c("sb"), spread), 4).alias("corr"))


def spike_ratio(monthly: DataFrame, entity: str, measure: str, months: Column, base: Column) -> DataFrame:
    """Mean of the chosen months over the mean of the base months, for the entity with the largest total."""
    per_month = monthly.groupBy(entity, "month_start").agg(F.sum(F.col(measure).cast(EXACT)).alias("v"))
    totals = per_month.groupBy(entity).agg(
        F.sum("v").alias("total"),
        F.avg(F.when(months, F.col("v"))).cast("double").alias("spike"),
        F.avg(F.when(base, F.col("v"))).cast("double").alias("usual"),
    )
    top = totals.agg(F.max_by(F.struct(entity, "spike", "usual"), F.struct("total", entity)).alias("t"))
    return top.select(F.col(f"t.{entity}").alias(entity), F.round(ratio(F.col("t.spike"), F.col("t.usual")), 2).alias("spike_ratio"))


def top_members(growth: DataFrame, key: str, n: int) -> DataFrame:
    """The ``n`` fastest growing members."""
    return growth.orderBy(F.col("growth_pct").desc_nulls_last(), key).limit(n).select(key, "growth_pct")


def story_checks(bridge: DataFrame, expectations: Sequence[tuple[str, Column]]) -> DataFrame:
    """One PASS/FAIL row per named condition over the yearly bridge (a condition is an aggregate)."""
    verdicts = bridge.agg(*[F.coalesce(c, F.lit(False)).alias(f"c{i}") for i, (_, c) in enumerate(expectations)])
    rows = F.array(
        *[
            F.struct(F.lit(name).alias("story"), F.when(F.col(f"c{i}"), "PASS").otherwise("FAIL").alias("status"))
            for i, (name, _) in enumerate(expectations)
        ]
    )
    return verdicts.select(F.inline(rows))


@dataclass(frozen=True)
class Story:
    """An expectation: the frame it is about, the figure found there (an aggregate) and whether it is as expected."""

    name: str
    frame: str
    found: Column
    holds: Column


def leaders(key: str) -> Column:
    """Members of a ranking in alphabetical order, as one text."""
    return F.array_join(F.array_sort(F.collect_set(key)), ", ")


def check_stories(frames: Mapping[str, DataFrame], stories: Sequence[Story]) -> DataFrame:
    """(story, found, status) of every expectation; each frame is aggregated once.  A figure that cannot be had fails."""
    result = None
    for name, frame in frames.items():
        told = [s for s in stories if s.frame == name]
        if not told:
            continue
        figures = frame.agg(*[c.alias(f"{p}{i}") for i, s in enumerate(told) for p, c in (("f", s.found.cast("string")), ("h", s.holds))])
        rows = [
            F.struct(F.lit(s.name).alias("story"), F.col(f"f{i}").alias("found"), F.when(F.col(f"h{i}"), "PASS").otherwise("FAIL").alias("status"))
            for i, s in enumerate(told)
        ]
        one = figures.select(F.inline(F.array(*rows)))
        result = one if result is None else result.unionByName(one)
    return result
