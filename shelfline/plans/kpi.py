"""Report measures over the marts: prior year, bridge, shares, top lists, forecast and platform figures.

A mart is first summed to (group, period step), which is small; prior-year values come from shifting those
rows forward instead of joining the mart to itself.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfline.functions.numbers import growth, ratio
from shelfline.plans.marts import BRIDGE_STEPS

CENTS = "decimal(24,3)"
TOP = 12
OVERSTOCK = 1.3


def last_data_date(mart: DataFrame, month: str = "month_start") -> DataFrame:
    """End of the newest month with data, whatever the filter: one row."""
    return mart.agg(F.last_day(F.max(month)).alias("last_date"))


def with_prior_years(
    mart: DataFrame,
    by: Sequence[str],
    step: str,
    period: Callable[[Column], Column],
    measures: Mapping[str, Column],
    last: DataFrame,
    years: int = 2,
    cut_current: bool = False,
) -> DataFrame:
    """Measures per (group, period) with ``<name>_py`` and ``<name>_ppy`` of the same dates one and two years
    before.  A prior-year date only counts while its counterpart is not after the last data date, so a
    partial year is compared with the same part of the year before.  ``cut_current`` applies the same limit
    to the current values."""
    base = mart.groupBy(*by, F.col(step).alias("_step")).agg(*[m.cast(CENTS).alias(n) for n, m in measures.items()])
    return shifted(base, by, period(F.col("_on")), list(measures), last, years, cut_current)


def shifted(
    base: DataFrame, by: Sequence[str], period: Column, measures: Sequence[str], last: DataFrame, years: int = 2, cut_current: bool = False
) -> DataFrame:
    """Sums by (group, ``_step``) moved on to the dates ``_on`` one and two years later, and summed by ``period``."""
    shifts = F.explode(F.array(*[F.lit(12 * k) for k in range(years + 1)]))
    moved = (
        base.withColumn("_shift", shifts)
        .withColumn("_on", F.add_months("_step", F.col("_shift")))
        .join(F.broadcast(last))
        .filter((F.col("_on") <= F.col("last_date")) | ((F.col("_shift") == 0) & F.lit(not cut_current)))
    )
    suffixes = ("", "_py", "_ppy")[: years + 1]
    summed = [
        F.sum(F.when(F.col("_shift") == 12 * k, F.col(n))).cast("double").alias(n + suffix)
        for n in measures
        for k, suffix in enumerate(suffixes)
    ]
    return moved.groupBy(*by, period.alias("period")).agg(*summed)


def sales_kpis(mart: DataFrame, by: Sequence[str] = (), period: Callable[[Column], Column] = F.year) -> DataFrame:
    """Commercial measures per group and period."""
    return sales_derived(with_prior_years(mart, by, "month_start", period, sales_sums(), last_data_date(mart)))


def sales_sums() -> dict[str, Column]:
    columns = {"net_sales": "net_sales_eur", "net_sales_cfx": "net_sales_cfx_eur", "volume_t": "volume_t", "cogs": "cogs_eur"}
    return {name: F.sum(F.col(c).cast(CENTS)) for name, c in columns.items()}


def sales_derived(base: DataFrame) -> DataFrame:
    """Growth, margin and display measures from sums with their prior years."""
    c = F.col
    growths = {
        "reported_growth": growth(c("net_sales"), c("net_sales_py")),
        "organic_growth": growth(c("net_sales_cfx"), c("net_sales_cfx_py")),
        "rig": growth(c("volume_t"), c("volume_t_py")),
        "organic_growth_py": growth(c("net_sales_cfx_py"), c("net_sales_cfx_ppy")),
        "rig_py": growth(c("volume_t_py"), c("volume_t_ppy")),
        "gross_margin": ratio(c("net_sales") - c("cogs"), c("net_sales")),
        "gross_margin_py": ratio(c("net_sales_py") - c("cogs_py"), c("net_sales_py")),
    }
    derived = {
        "pricing": c("organic_growth") - c("rig"),
        "pricing_py": c("organic_growth_py") - c("rig_py"),
        "fx_effect": c("reported_growth") - c("organic_growth"),
        "gross_margin_vs_py_pp": (c("gross_margin") - c("gross_margin_py")) * 100,
        "net_sales_m": c("net_sales") / 1e6,
        "net_sales_m_py": c("net_sales_py") / 1e6,
        "net_sales_yoy": growth(c("net_sales"), c("net_sales_py")),
        "volume_kt": c("volume_t") / 1000,
        "volume_kt_py": c("volume_t_py") / 1000,
        "volume_kt_yoy": growth(c("volume_t"), c("volume_t_py")),
    }
    hidden = [n for n in base.columns if n.endswith("_ppy")]
    return base.withColumns(growths).withColumns(derived).drop(*hidden)


def bridge_steps(kpis: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Prior-year sales, volume, pricing and currency as steps to current sales, in millions; blank without a
    prior year."""
    py = F.col("net_sales_py")
    values = (
        py,
        py * F.col("rig"),
        py * F.col("pricing"),
        F.col("net_sales") - py * (1 + F.col("organic_growth")),
    )
    steps = F.array(
        *[
            F.struct(F.lit(s).alias("step"), F.lit(i + 1).alias("step_order"), F.when(py.isNotNull(), v / 1e6).alias("value_m"))
            for i, (s, v) in enumerate(zip(BRIDGE_STEPS, values, strict=True))
        ]
    )
    return kpis.select(*keys, F.inline(steps))


def share_of_total(df: DataFrame, within: Sequence[str], measure: str, name: str) -> DataFrame:
    """Share of the total over the selected members; the totals are an aggregate of their own."""
    totals = df.groupBy(*within).agg(F.sum(measure).alias("_total"))
    joined = df.join(totals, list(within)) if within else df.join(F.broadcast(totals))
    return joined.withColumn(name, ratio(F.col(measure), F.col("_total"))).drop("_total")


def top_ranked(df: DataFrame, measure: str, n: int = TOP, name: str = "rank") -> DataFrame:
    """Members ranked at most ``n`` by a measure; ties share a rank, so more than ``n`` rows may remain.

    The n-th largest value comes from a distributed top-n; only the members at or above it are ranked.
    """
    best = df.select(measure).filter(F.col(measure).isNotNull()).orderBy(F.col(measure).desc()).limit(n)
    threshold = F.broadcast(best.agg(F.min(measure).alias("_least")))
    kept = df.join(threshold, F.col(measure) >= F.col("_least")).drop("_least")
    return kept.withColumn(name, F.rank().over(Window.orderBy(F.col(measure).desc())))


def stock_cover(mart: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Weeks of stock at the last week with a known stock: stock over the four-week mean of sell-out."""
    exact = lambda c: F.sum(F.col(c).cast("decimal(24,6)"))
    weekly = mart.groupBy(*by, "week_ending").agg(exact("stock_cases").alias("stock"), exact("sell_out_4w_avg").alias("mean"))
    last = weekly.filter("stock IS NOT NULL").groupBy(*by).agg(F.max_by(F.struct("stock", "mean"), "week_ending").alias("_last"))
    return last.select(*by, ratio(F.col("_last.stock"), F.col("_last.mean")).alias("stock_cover"))


def stock_cover_top(mart: DataFrame, by: str = "distributor_name", n: int = TOP) -> DataFrame:
    """Members with the highest cover, the network's cover, and who holds far more than the network."""
    members = top_ranked(stock_cover(mart, [by]), "stock_cover", n)
    network = stock_cover(mart).select(F.col("stock_cover").alias("network_cover"))
    flagged = members.join(F.broadcast(network))
    return flagged.withColumn("is_overstocked", F.col("stock_cover") > OVERSTOCK * F.col("network_cover"))


def sellout_kpis(mart: DataFrame, sales_mart: DataFrame, by: Sequence[str] = (), period=F.year) -> DataFrame:
    """Sell-out, sell-in (thousand cases) and sell-through up to the last data date, with prior year."""
    measures = sellout_sums()
    base = with_prior_years(mart, by, "week_ending", period, measures, last_data_date(sales_mart), years=1, cut_current=True)
    return sellout_derived(base, by)


def sellout_sums() -> dict[str, Column]:
    return {name: F.sum(F.col(f"{name}_cases").cast(CENTS)) for name in ("sell_out", "sell_in")}


def sellout_derived(base: DataFrame, by: Sequence[str]) -> DataFrame:
    c = F.col
    through = {
        "sell_through": ratio(c("sell_out"), c("sell_in")),
        "sell_through_py": ratio(c("sell_out_py"), c("sell_in_py")),
    }
    return base.withColumns(through).select(
        *by,
        "period",
        (c("sell_out") / 1000).alias("sell_out_k"),
        (c("sell_in") / 1000).alias("sell_in_k"),
        (c("sell_out_py") / 1000).alias("sell_out_k_py"),
        (c("sell_in_py") / 1000).alias("sell_in_k_py"),
        growth(c("sell_out"), c("sell_out_py")).alias("sell_out_yoy"),
        *through,
        ((c("sell_through") - c("sell_through_py")) * 100).alias("sell_through_vs_py_pp"),
    )


def promo_kpis(mart: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Uplift over all promotions of a group against the planned one."""
    exact = "decimal(24,6)"
    summed = mart.groupBy(*by).agg(
        F.sum(F.col("promo_cases").cast(exact)).alias("promo"),
        F.sum(F.col("baseline_cases").cast(exact)).alias("baseline"),
        F.avg(F.col("planned_uplift_pct").cast("double")).alias("planned"),
    )
    uplift = ratio(F.col("promo"), F.col("baseline")) - 1
    return summed.select(
        *by, uplift.alias("promo_uplift"), (F.col("planned") / 100).alias("planned_uplift")
    ).withColumn("beats_plan", F.col("promo_uplift") >= F.col("planned_uplift"))


def forecast_kpis(forecast: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Accuracy of forecast and baseline on the test weeks, per group, ignoring any date filter."""
    test = ~F.col("is_future")
    a, f, b = (F.col(c).cast(CENTS) for c in ("actual_t", "forecast_t", "baseline_t"))
    positive = test & (F.col("actual_t") > 0)
    exact = lambda v: F.sum(v).cast("double")
    error = lambda v: exact(F.when(test, F.abs(a - v)))
    bias = lambda v: exact(F.when(test, v - a))
    ape = lambda c: F.avg(F.when(positive, F.abs(F.col("actual_t") - F.col(c)) / F.col("actual_t")))
    summed = forecast.groupBy(*by).agg(
        exact(F.when(test, a)).alias("actual_t"),
        exact(f).alias("forecast_t"),
        exact(b).alias("seasonal_naive_t"),
        error(f).alias("_err"),
        error(b).alias("_err_base"),
        bias(f).alias("_bias"),
        bias(b).alias("_bias_base"),
        ape("forecast_t").alias("mape"),
        ape("baseline_t").alias("baseline_mape"),
    )
    actual = F.col("actual_t")
    return summed.select(
        *by,
        "actual_t",
        "forecast_t",
        "seasonal_naive_t",
        (1 - ratio(F.col("_err"), actual)).alias("forecast_accuracy"),
        (1 - ratio(F.col("_err_base"), actual)).alias("baseline_accuracy"),
        "mape",
        "baseline_mape",
        ratio(F.col("_bias"), actual).alias("bias"),
        ratio(F.col("_bias_base"), actual).alias("baseline_bias"),
    ).withColumn("bias_within_5pct", F.abs("bias") <= 0.05)


def star(mart: DataFrame, dims: Mapping[str, tuple[DataFrame, str, Sequence[str]]]) -> DataFrame:
    """Attach dimension attributes: mart column -> (dimension, its key, attributes).  Left joins, so a mart
    row without a member stays."""
    for column, (dim, key, attributes) in dims.items():
        member = dim.select(F.col(key).alias(f"_{column}"), *attributes)
        mart = mart.join(member, F.col(column) == F.col(f"_{column}"), "left").drop(f"_{column}")
    return mart


# filter context -------------------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Slice:
    """A visual of a report page: the columns it groups by, and whether it shows months or years."""

    name: str
    columns: tuple[str, ...] = ()
    monthly: bool = False


@dataclass(frozen=True)
class Selection:
    """What the slicers of a page select: members by column, and years.  An empty selection of a column is all of it."""

    members: Mapping[str, Sequence[object]] = field(default_factory=dict)
    years: Sequence[int] = ()

    def of_members(self, df: DataFrame) -> DataFrame:
        """Filters before the aggregation, so that they reach the scan."""
        for column, members in self.members.items():
            if members:
                df = df.filter(F.col(column).isin(list(members)))
        return df


def page(
    mart: DataFrame,
    slices: Sequence[Slice],
    selection: Selection,
    step: str,
    measures: Mapping[str, Column],
    last: DataFrame,
    years: int = 2,
    cut_current: bool = False,
) -> DataFrame:
    """All visuals of a page from one scan and one aggregation: (slice, members, period, measures with prior years).

    The slices are grouping sets over their columns and the period step; a period starts on the first of its year or
    month.  The selection of years applies to periods, not to rows, so a selected year still finds its prior years.
    ``members`` is the list of a row's members in the order of its slice's columns."""
    columns = list(dict.fromkeys(c for s in slices for c in s.columns))
    kept = selection.of_members(mart)
    if not columns:
        columns = [step]
    ids = {s.name: sum(0 if c in s.columns else 1 << (len(columns) - 1 - i) for i, c in enumerate(columns)) for s in slices}
    sets = {tuple(s.columns) for s in slices}
    grouped = kept.withColumn("_step", F.col(step)).groupingSets(
        [[F.col("_step"), *[F.col(c) for c in one]] for one in sorted(sets)], F.col("_step"), *[F.col(c) for c in columns]
    )
    base = grouped.agg(F.grouping_id().alias("_gid"), *[m.cast(CENTS).alias(n) for n, m in measures.items()])
    visuals = [
        F.when(
            F.col("_gid") == ids[s.name],
            F.struct(F.lit(s.name).alias("slice"), F.lit(s.monthly).alias("_monthly"), F.array(*[F.col(c).cast("string") for c in s.columns]).cast("array<string>").alias("members")),
        )
        for s in slices
    ]
    shown = base.withColumn("_v", F.explode(F.array_compact(F.array(*visuals)))).select("_v.*", "_step", *measures)
    period = F.when(F.col("_monthly"), F.trunc("_on", "month")).otherwise(F.trunc("_on", "year"))
    result = shifted(shown, ["slice", "members", "_monthly"], period, list(measures), last, years, cut_current).drop("_monthly")
    return result.filter(F.year("period").isin(list(selection.years))) if selection.years else result


def sales_page(mart: DataFrame, slices: Sequence[Slice], selection: Selection) -> DataFrame:
    """The sales measures of a page, and each row's share of its slice's total in the period."""
    # the newest data date ignores the selection
    found = sales_derived(page(mart, slices, selection, "month_start", sales_sums(), last_data_date(mart)))
    return share_of_total(found, ["slice", "period"], "net_sales", "net_sales_share")


def sellout_page(mart: DataFrame, sales_mart: DataFrame, slices: Sequence[Slice], selection: Selection) -> DataFrame:
    base = page(mart, slices, selection, "week_ending", sellout_sums(), last_data_date(sales_mart), years=1, cut_current=True)
    return sellout_derived(base, ["slice", "members"])
