"""Star schema and KPI marts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfline.functions.dates import calendar_columns, month_of, week_ending, week_of
from shelfline.functions.numbers import growth, ratio, share_of, sum_where, total, unit_sum
from shelfline.operators.lookup import join_fx
from shelfline.operators.sales import reportable
from shelfline.operators.scd2 import current_versions
from shelfline.operators.series import day_spine, published_average, trailing_mean

BASELINE_WEEKS = 8
TRAILING_WEEKS = 4


# dimensions ---------------------------------------------------------------------------------------------


def dim_date(bounds: DataFrame) -> DataFrame:
    """One row per day between ``first_day`` and ``last_day``."""
    return day_spine(bounds, "date").withColumns(calendar_columns(F.col("date")))


def dim_country(countries: DataFrame, regions: DataFrame) -> DataFrame:
    """Countries that belong to a region; both sides are country lists."""
    return countries.join(F.broadcast(regions), "country_code")


def dim_product(products: DataFrame) -> DataFrame:
    return current_versions(products).select(
        "sku",
        "product_name",
        "brand",
        "category",
        "subcategory",
        "pack_size",
        "units_per_case",
        "case_weight_kg",
        "ean",
        "status",
        "launch_date",
        "discontinued_date",
    )


def dim_customer(customers: DataFrame) -> DataFrame:
    """Current customers without contact data."""
    return current_versions(customers).select(
        "customer_id", "customer_name", "country_code", "channel", "customer_type", "key_account_manager", "is_distributor"
    )


def member_list(dim: DataFrame, column: str) -> DataFrame:
    return dim.select(column).distinct()


# Bridge steps in display order.
BRIDGE_STEPS = ("Net sales PY", "Volume (RIG)", "Pricing", "FX")


def dim_bridge_step(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(s, i + 1) for i, s in enumerate(BRIDGE_STEPS)], "step string, step_order int")


def tonnes(kg: Column) -> Column:
    """Sum of kilograms (whole grams) in tonnes."""
    return F.round(unit_sum(kg, 3) / 1e6, 3)


# sales --------------------------------------------------------------------------------------------------


def mart_sales_monthly(lines: DataFrame, fx: DataFrame, base_year: int) -> DataFrame:
    """Month x country x channel x SKU.  Constant-currency sales use the base year's published rates."""
    # one row per currency
    base = F.broadcast(published_average(fx, base_year))
    at_base = ratio(F.col("net_amount_lc"), F.col("base_rate"))
    return (
        reportable(lines)
        .join(base, "currency")
        .groupBy(month_of(F.col("order_date")).alias("month_start"), "country_code", "channel", "sku", "category")
        .agg(
            F.sum(F.col("qty_cases").cast("long")).alias("cases"),
            tonnes(F.col("volume_kg")).alias("volume_t"),
            total(F.col("gross_amount_eur")).alias("gross_sales_eur"),
            total(F.col("net_amount_eur")).alias("net_sales_eur"),
            F.round(F.sum(at_base), 2).alias("net_sales_cfx_eur"),
            *[total(F.col(c)).alias(c) for c in ("cogs_eur",) if c in lines.columns],
            F.coalesce(total(F.when(F.col("is_promo"), F.col("net_amount_eur"))), F.lit(0.0)).alias("promo_net_sales_eur"),
            F.count(F.lit(1)).alias("order_lines"),
        )
    )


def growth_bridge(mart: DataFrame, last_month: int) -> DataFrame:
    """Organic growth, volume, pricing and currency effect per year over the months up to ``last_month``."""
    cents = "decimal(20,3)"
    yearly = (
        mart.filter(F.month("month_start") <= last_month)
        .groupBy(F.year("month_start").alias("year"))
        .agg(
            F.sum(F.col("net_sales_eur").cast(cents)).cast("double").alias("net"),
            F.sum(F.col("net_sales_cfx_eur").cast(cents)).cast("double").alias("cfx"),
            F.sum(F.col("volume_t").cast(cents)).cast("double").alias("vol"),
        )
    )
    # one row per year: the global window sees a few dozen rows
    by_year = Window.orderBy("year")
    changes = {
        f"{name}_growth": growth(F.col(name), F.lag(name).over(by_year)) for name in ("net", "cfx", "vol")
    }
    pct = lambda c: F.round(100 * c, 1)
    return yearly.withColumns(changes).select(
        "year",
        F.round(F.col("net") / 1e6, 1).alias("net_sales_eur_m"),
        pct(F.col("cfx_growth")).alias("organic_growth_pct"),
        pct(F.col("vol_growth")).alias("rig_pct"),
        pct(F.col("cfx_growth") - F.col("vol_growth")).alias("pricing_pct"),
        pct(F.col("net_growth") - F.col("cfx_growth")).alias("fx_effect_pct"),
    )


# sell-in against sell-out ---------------------------------------------------------------------------------


def weekly_sell_in(lines: DataFrame, distributors: DataFrame, customer: str = "customer_id") -> DataFrame:
    """Reportable sales to distributors per week and category.  Aggregated before the distributor filter,
    so the semi join runs on weekly rows."""
    weekly = reportable(lines).groupBy(
        week_ending(F.col("order_date")).alias("week_ending"), F.col(customer).alias("distributor_id"), "category"
    ).agg(
        F.sum(F.col("qty_cases").cast("long")).alias("sell_in_cases"),
        total(F.col("net_amount_eur")).alias("sell_in_eur"),
    )
    return weekly.join(distributors.select("distributor_id"), "distributor_id", "left_semi")


def weekly_sell_out(sellout: DataFrame) -> DataFrame:
    return sellout.groupBy("week_ending", "distributor_id", "category").agg(
        total(F.col("qty_cases"), 3).alias("sell_out_cases"), total(F.col("stock_cases"), 3).alias("stock_cases")
    )


def mart_sellin_sellout_weekly(sell_in: DataFrame, sell_out: DataFrame, distributors: DataFrame) -> DataFrame:
    """Week x distributor x category.  A missing side counts as 0, a missing stock stays unknown.  The window
    runs over the weeks of one distributor and category: bounded by the calendar."""
    keys = ["week_ending", "distributor_id", "category"]
    aligned = sell_in.join(sell_out, keys, "full_outer").select(
        *keys,
        F.coalesce("sell_in_cases", F.lit(0)).alias("sell_in_cases"),
        F.coalesce("sell_in_eur", F.lit(0.0)).alias("sell_in_eur"),
        F.coalesce("sell_out_cases", F.lit(0.0)).alias("sell_out_cases"),
        "stock_cases",
    )
    with_mean = aligned.withColumn(
        "sell_out_4w_avg",
        trailing_mean(["distributor_id", "category"], "week_ending", F.col("sell_out_cases"), TRAILING_WEEKS),
    )
    covered = with_mean.withColumn("stock_cover_weeks", F.round(ratio(F.col("stock_cases"), F.col("sell_out_4w_avg")), 2))
    names = distributors.select("distributor_id", "distributor_name", "country_code")
    return covered.join(names, "distributor_id")


# promotions -----------------------------------------------------------------------------------------------


def mart_promo_performance(
    lines: DataFrame, promotions: DataFrame, customers: DataFrame, customer: str = "customer_id"
) -> DataFrame:
    """Promotion volume against the eight weeks before it, as far as they begin by the promotion's end.

    Each promotion is spread over its own weeks (baseline plus duration, a dozen rows), which turns the
    interval join into an equi join on customer, category and week.
    """
    weekly = reportable(lines).groupBy(
        F.col(customer).alias("customer_id"), "category", week_of(F.col("order_date")).alias("week_start")
    ).agg(
        F.sum(F.col("qty_cases").cast("long")).alias("cases"),
        unit_sum(F.col("net_amount_eur"), 2).alias("net_cents"),
        unit_sum(F.col("cogs_eur"), 2).alias("cogs_cents"),
    )

    def euros(cents: Column) -> Column:
        return (cents.cast("decimal(18,0)") * F.lit("0.01").cast("decimal(3,2)")).cast("decimal(18,2)")

    first_monday = week_of(F.date_add(F.col("start_date"), 6 - 7 * BASELINE_WEEKS))
    # the baseline ends with the promotion too, so one that ends before it starts has fewer weeks of baseline
    weeks = F.when(F.col("end_date") >= first_monday, F.sequence(first_monday, F.col("end_date"), F.expr("INTERVAL 7 DAYS")))
    spread = promotions.withColumn("week_start", F.explode(weeks))
    during = F.col("week_start") >= F.col("start_date")
    before = ~during
    per_promo = (
        spread.join(weekly, ["customer_id", "category", "week_start"])
        .groupBy(*promotions.columns)
        .agg(
            sum_where(during, F.col("cases")).alias("promo_cases"),
            euros(sum_where(during, F.col("net_cents"))).alias("promo_net_eur"),
            euros(sum_where(during, F.col("cogs_cents"))).alias("promo_cogs_eur"),
            sum_where(before, F.col("cases")).cast("decimal(18,0)").alias("_base_cases"),
            euros(sum_where(before, F.col("net_cents"))).alias("_base_net"),
        )
    )
    # the baseline is a mean over eight weeks times the weeks of the promotion, kept exact
    per_week = F.lit(str(1 / BASELINE_WEEKS)).cast("decimal(4,3)") * F.col("duration_weeks")
    measured = per_promo.withColumns(
        {"baseline_cases": F.col("_base_cases") * per_week, "baseline_net_eur": F.col("_base_net") * per_week}
    ).filter("baseline_cases > 0")
    given_away = F.try_divide(F.col("promo_net_eur") * F.col("discount_pct"), 1 - F.col("discount_pct"))
    cost_share = ratio(F.col("promo_cogs_eur"), F.col("promo_net_eur"))
    # both sides at the cost share of the promotion itself
    margin = (F.col("promo_net_eur") - F.col("promo_cogs_eur")).cast("double")
    gain = margin - F.col("baseline_net_eur").cast("double") * (1 - cost_share)
    result = measured.select(
        *promotions.columns,
        "promo_cases",
        "promo_net_eur",
        "promo_cogs_eur",
        "baseline_cases",
        "baseline_net_eur",
        F.round(100 * (ratio(F.col("promo_cases"), F.col("baseline_cases")) - 1), 1).alias("uplift_pct"),
        F.round(F.col("promo_net_eur") - F.col("baseline_net_eur"), 2).alias("incremental_net_eur"),
        F.round(given_away, 2).alias("discount_cost_eur"),
        F.round(ratio(gain, given_away), 2).alias("promo_roi"),
    )
    return result.join(customers.select("customer_id", "country_code", "channel"), "customer_id")


# demand ---------------------------------------------------------------------------------------------------


def weather_weekly(weather: DataFrame) -> DataFrame:
    tenths = "decimal(12,4)"
    return weather.groupBy(week_of(F.col("weather_date")).alias("week_start"), "country_code").agg(
        F.round(F.sum(F.col("temp_mean_c").cast(tenths)).cast("double") / F.count("temp_mean_c"), 2).alias("temp_mean_c"),
        F.round(F.sum(F.col("precipitation_mm").cast(tenths)), 1).cast("double").alias("precipitation_mm"),
    )


def mart_demand_weekly(lines: DataFrame, weather: DataFrame, inflation: DataFrame) -> DataFrame:
    """Week x country x category with weather and inflation (both one row per country and calendar step)."""
    sales = reportable(lines).groupBy(
        week_of(F.col("order_date")).alias("week_start"), "country_code", "category"
    ).agg(
        tonnes(F.col("volume_kg")).alias("volume_t"),
        total(F.col("net_amount_eur")).alias("net_sales_eur"),
        share_of(F.col("is_promo")).alias("promo_line_share"),
    )
    monthly = inflation.select("country_code", F.col("month").alias("_month"), "food_inflation_yoy_pct")
    return (
        sales.withColumn("_month", month_of(F.col("week_start")))
        .join(F.broadcast(weather_weekly(weather)), ["week_start", "country_code"], "left")
        .join(F.broadcast(monthly), ["country_code", "_month"], "left")
        .drop("_month")
    )


# events ---------------------------------------------------------------------------------------------------


def mart_pos_daily(events: DataFrame, products: DataFrame, fx: DataFrame) -> DataFrame:
    """Day x country x retailer x category.  Whatever is not a purchase counts negative; an unknown barcode
    keeps its events under an empty category, an unknown currency adds nothing to the revenue."""
    known = events.join(products.select("ean", "category"), "ean", "left")
    priced = join_fx(known, fx, "event_date")
    sign = F.when(F.col("event_type") == "purchase", 1).otherwise(-1)
    revenue = ratio(sign * F.col("quantity") * F.col("unit_price"), F.col("rate_per_eur"))
    return priced.groupBy("event_date", "country", "retailer_id", "category").agg(
        F.sum((sign * F.col("quantity")).cast("long")).alias("net_units"),
        F.round(F.sum(revenue), 2).alias("net_revenue_eur"),
        F.count(F.lit(1)).alias("events"),
        F.count("device").alias("events_with_device"),
    )


def table_counts(tables: dict[tuple[str, str], DataFrame]) -> DataFrame:
    """Row count per (layer, table), one aggregate each in a single job."""
    counted = None
    for (layer, name), df in tables.items():
        one = df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(layer).alias("layer"), F.lit(name).alias("table_name"), "row_count"
        )
        counted = one if counted is None else counted.unionByName(one)
    return counted
