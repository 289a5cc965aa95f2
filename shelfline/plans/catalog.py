"""Registered queries: each runs one part of the engine over the whole test tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline.functions.dates import month_of
from shelfline.functions.hashing import checksum, portable_checksum
from shelfline.functions.numbers import count_where
from shelfline.functions.text import barcode, ean13_valid
from shelfline.operators import dedup, forecast, governance, lookup, quality, reconcile, runlog, sales, scd2, sellout, series
from shelfline.operators.scan import heavy_keys
from shelfline.plans import kpi, marts, stories
from shelfline.plans.driver_views import (
    BASE_YEAR,
    CUSTOMER_FIELDS,
    LAST_MONTH,
    PROFILE_FIELDS,
    DriverViews,
)
from shelfline.schemas import POS_EVENT, SELLOUT_A, SELLOUT_B, SELLOUT_JSON
from shelfline.session import pin, scratch, tune
from shelfline.sources import tables
from shelfline.streaming import event_table
from shelfline.streaming import events as pos
from shelfline.streaming import ingest

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
USER = "user7"


def query(build: Callable[[DriverViews], DataFrame]) -> Callable[[DriverViews], DataFrame]:
    """Register a query under its function name."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        return plain_types(build(DriverViews(tune(spark), folder)))

    QUERIES[build.__name__] = run
    return build


def plain_types(df: DataFrame) -> DataFrame:
    """Decimals as doubles and instants without a zone, for comparison with another engine."""
    shown = []
    for name, kind in df.dtypes:
        column = F.col(f"`{name}`")
        if kind.startswith("decimal") and not kind.endswith(",0)"):
            column = column.cast("double")
        elif kind == "timestamp":
            column = column.cast("timestamp_ntz")
        shown.append(column.alias(name))
    return df.select(*shown)


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """All doubles to a fixed number of digits."""
    return df.select(
        *[F.round(F.col(n), digits).alias(n) if kind == "double" or kind.startswith("decimal") else F.col(n) for n, kind in df.dtypes]
    )


# shared intermediate frames (plans, not data) -----------------------------------------------------------------


def lines_of(v: DriverViews, *without: str) -> DataFrame:
    return sales.sales_order_lines(
        v.order_lines, v.orders, v.customers_scd2, v.products_scd2, v.fx, None if sales.COST in without else v.standard_cost, without
    )


def monthly_of(v: DriverViews, *without: str) -> DataFrame:
    return marts.mart_sales_monthly(lines_of(v, *without), v.fx, BASE_YEAR)


def stored_monthly_of(v: DriverViews) -> DataFrame:
    """The mart as a table, for measures that read it several times."""
    return pin(monthly_of(v), "sales-monthly")


def conformed_of(v: DriverViews) -> DataFrame:
    products = marts.dim_product(v.products_scd2)
    return sellout.conform_sellout(v.sellout_raw, products, v.aliases, v.distributors)


def weekly_sellout_of(v: DriverViews) -> DataFrame:
    return sellout.weekly_sellout(sellout.valid_rows(conformed_of(v)))


def sellin_sellout_of(v: DriverViews, lines: DataFrame | None = None) -> DataFrame:
    lines = lines_of(v, sales.CUSTOMER, sales.COST) if lines is None else lines
    sell_in = marts.weekly_sell_in(lines, v.distributors, "distributor_id")
    return marts.mart_sellin_sellout_weekly(sell_in, marts.weekly_sell_out(weekly_sellout_of(v)), v.distributors)


def demand_of(v: DriverViews) -> DataFrame:
    return marts.mart_demand_weekly(lines_of(v, sales.COST), series.weather_daily(v.weather_raw), series.inflation_monthly(v.inflation_raw))


def promo_of(v: DriverViews) -> DataFrame:
    return marts.mart_promo_performance(lines_of(v, sales.CUSTOMER), sales.typed_promotions(v.promotions), v.customers)


def features_of(v: DriverViews) -> DataFrame:
    # the weekly series is small against the order lines it comes from and is read four times
    demand = pin(demand_of(v).select("week_start", "country_code", "category", "volume_t", "promo_line_share", "temp_mean_c"))
    return forecast.features(forecast.forecast_frame(demand, forecast.last_full_week(demand)))


# sales --------------------------------------------------------------------------------------------------------


@query
def growth_bridge(v):
    return marts.growth_bridge(monthly_of(v, sales.COST), LAST_MONTH)


@query
def sales_monthly(v):
    return monthly_of(v)


@query
def sales_yearly(v):
    return sales.sales_yearly(lines_of(v, sales.CUSTOMER))


@query
def order_lines_enriched(v):
    lines = lines_of(v)
    flags = {f"has_{k}": F.col(f"{k}_sk").isNotNull() for k in ("customer", "product")}
    return rounded(lines.withColumns(flags).drop("customer_sk", "product_sk"))


@query
def fact_sales(v):
    return sales.fact_sales(lines_of(v)).drop("customer_sk", "product_sk")


@query
def returns_eur(v):
    return sales.returns_eur(v.returns, v.orders, v.fx)


@query
def promotions_typed(v):
    return sales.typed_promotions(v.promotions)


# point in time ---------------------------------------------------------------------------------------------------


@query
def pit_customer(v):
    take = {"version": "version", "customer_channel": "channel", "customer_type": "customer_type", "manager": "key_account_manager"}
    facts = v.orders.select("order_id", "order_date", "customer_id")
    return lookup.pit_join(facts, v.customers_scd2, "customer_id", F.col("order_date"), take)


@query
def pit_product(v):
    keys = v.order_lines.select("order_id", "line_no", "sku", "qty_cases")
    facts = sales.join_header(keys, v.orders.select("order_id", "order_date"))
    take = {"version": "version", "pack_size": "pack_size", "case_weight_kg": "case_weight_kg"}
    return lookup.pit_join(facts, v.products_scd2, "sku", F.col("order_date"), take)


@query
def pit_profile(v):
    purchases = v.table("events").filter("event_type = 'purchase'").select("event_id", "user_id", "ts")
    take = {"version": "version", "signup": "signup", "view": "view", "click": "click"}
    return lookup.pit_join(purchases, v.profiles_scd2, "user_id", F.col("ts"), take, dense=16)


@query
def pit_overlaps(v):
    """Every view of the user within two days before a purchase: intervals overlap and users have many."""
    events = v.table("events")
    purchases = events.filter("event_type = 'purchase'").select("event_id", "user_id", "ts")
    views = events.filter("event_type = 'view'").select(
        "user_id", F.col("event_id").alias("view_id"), F.col("ts").alias("valid_from"), F.expr("ts + INTERVAL 2 DAYS").alias("valid_to")
    )
    found = lookup.pit_join(purchases, views, "user_id", F.col("ts"), {"view_id": "view_id"}, dense=4)
    return found.select("event_id", "view_id")


@query
def asof_price(v):
    facts = sales.join_header(v.order_lines.select("order_id", "line_no", "sku"), v.orders.select("order_id", "order_date"))
    take = {"list_price_case": "list_price_case", "price_from": "valid_from"}
    # the busy SKUs are known from the lines alone
    heavy = heavy_keys(v.order_lines, ["sku"])
    return lookup.asof_join(facts, v.price_list, ["sku"], "order_date", "valid_from", take, heavy=heavy)


@query
def price_factor(v):
    index = series.inflation_monthly(v.inflation_raw).select("country_code", "month", F.col("food_index").alias("index_value"))
    rounds = v.price_list.select("valid_from").distinct().filter("valid_from > '1995-06-01'")
    # country 3 publishes no index and takes the mean
    return series.price_factor(
        index.filter("country_code <> '3'"), rounds, v.countries.select("country_code"), F.lit("1995-01-01").cast("date"), 0.6
    )


@query
def price_contiguity(v):
    broken = lookup.contiguity(v.price_list, ["sku"]).filter(~F.col("is_contiguous"))
    return broken.select("sku", "valid_from", "valid_to", "next_start")


# history ---------------------------------------------------------------------------------------------------------


@query
def scd2_customers(v):
    return v.customers_scd2.select(
        "customer_id", *CUSTOMER_FIELDS, "customer_type", "valid_from", "valid_to", "is_current", "version"
    )


@query
def scd2_products(v):
    return v.products_scd2.select(
        "sku", "product_name", "pack_size", "case_weight_kg", "valid_from", "valid_to", "is_current", "version"
    )


@query
def scd2_profiles(v):
    return v.profiles_scd2.select("user_id", *PROFILE_FIELDS, "valid_from", "valid_to", "is_current", "version")


@query
def scd2_keys(v):
    keyed = scd2.with_surrogate_key(v.profiles_scd2, "user_id", "profile_sk")
    return keyed.agg(F.count(F.lit(1)).alias("versions"), F.countDistinct("profile_sk").alias("distinct_keys"))


@query
def scd2_checks(v):
    rows = None
    for name, log, history, current, key, fields in (
        ("customers_scd2", v.customer_changes, v.customers_scd2, v.customers, "customer_id", CUSTOMER_FIELDS),
        ("products_scd2", v.product_changes, v.products_scd2, v.products, "sku", ("pack_size",)),
        ("profiles_scd2", v.profile_changes, v.profiles_scd2, v.profiles, "user_id", PROFILE_FIELDS),
    ):
        kept = history.select(key, "valid_from", "valid_to", "is_current", "version")
        keys = kept.agg(F.countDistinct(key).alias("total_rows"))
        noop = quality.run_checks(
            log, [quality.condition_check("silver", name, "no_op_audit_entries_ignored", scd2.is_noop(), 5.0)]
        )
        current_bad = scd2.keys_without_single_current(kept, key).agg(F.count(F.lit(1)).alias("failed_rows"))
        overlap_bad = scd2.count_overlaps(kept, key).agg(F.coalesce(F.sum("overlaps"), F.lit(0)).alias("failed_rows"))
        matches = quality.log_matches_current(scd2.drop_noop(log), current, key, fields).agg(
            F.sum("total_rows").alias("total_rows"), F.sum("failed_rows").alias("failed_rows")
        )
        counted = None
        for check, df in (
            ("exactly_one_current_row", current_bad.crossJoin(keys)),
            ("no_overlapping_versions", overlap_bad.crossJoin(keys)),
            ("last_audited_value_is_current", matches),
        ):
            one = df.select(
                F.lit("silver").alias("layer"),
                F.lit(name).alias("table_name"),
                F.lit(check).alias("check_name"),
                "failed_rows",
                "total_rows",
                F.lit(0.0).alias("threshold_pct"),
            )
            counted = one if counted is None else counted.unionByName(one)
        found = noop.unionByName(quality.judge(counted))
        rows = found if rows is None else rows.unionByName(found)
    return rounded(rows)


# reference series --------------------------------------------------------------------------------------------------


@query
def fx_daily(v):
    return v.fx


@query
def inflation_yoy(v):
    return series.inflation_monthly(v.inflation_raw)


@query
def weather_weekly(v):
    return marts.weather_weekly(series.weather_daily(v.weather_raw))


# dimensions ---------------------------------------------------------------------------------------------------------


@query
def dim_date(v):
    return marts.dim_date(v.order_span)


@query
def dim_country(v):
    return marts.dim_country(v.countries, v.regions)


@query
def dim_product(v):
    return marts.dim_product(v.products_scd2)


@query
def dim_customer(v):
    return marts.dim_customer(v.customers_scd2)


@query
def dim_lists(v):
    category = marts.member_list(v.products, "category").select(F.lit("category").alias("list"), F.col("category").alias("member"))
    channel = marts.member_list(v.customers, "channel").select(F.lit("channel").alias("list"), F.col("channel").alias("member"))
    return category.unionByName(channel)


# sell-out -----------------------------------------------------------------------------------------------------------


def _layout_frames(v: DriverViews) -> dict[str, DataFrame]:
    """The dirty rows in each layout's own column names."""
    frames = {}
    for name, layout in sellout.LAYOUTS.items():
        own = v.sellout_raw.filter(F.col("layout") == name)
        frames[name] = own.select(*[F.col(r).alias(c) for r, c in zip(sellout.RAW_COLUMNS[1:8], layout.columns, strict=True)], "_source_file")
    return frames


@query
def sellout_unify(v):
    return sellout.unify_layouts(**_layout_frames(v))


@query
def sellout_clean(v):
    return weekly_sellout_of(v)


@query
def sellout_rejects(v):
    return sellout.rejected_rows(conformed_of(v)).drop("_rejected_at")


@query
def reject_summary(v):
    return sellout.reject_summary(sellout.rejected_rows(conformed_of(v)))


@query
def sellout_dedup(v):
    valid = sellout.valid_rows(conformed_of(v))
    copies = valid.groupBy(*sellout.DEDUP_KEY).agg(F.count(F.lit(1)).alias("copies"))
    return copies.groupBy("distributor_id").agg(
        F.count(F.lit(1)).alias("kept"),
        F.sum(F.col("copies") - 1).alias("removed"),
        F.countDistinct("week_ending", "sku").alias("distinct_week_sku"),
    )


@query
def sellin_sellout(v):
    return rounded(sellin_sellout_of(v))


@query
def promo_performance(v):
    return rounded(promo_of(v))


@query
def demand_weekly(v):
    return demand_of(v)


# plausibility ---------------------------------------------------------------------------------------------------------


@query
def yoy_pivot(v):
    return stories.yoy_pivot(monthly_of(v, sales.COST), "category", "net_sales_cfx_eur", (1999, 2000))


@query
def ytd_growth(v):
    return stories.ytd_growth(monthly_of(v, sales.COST), LAST_MONTH)


@query
def group_corr(v):
    return stories.group_corr(demand_of(v).filter("category = 'ECONOMY'"), "country_code", "temp_mean_c", "volume_t")


@query
def spike_ratio(v):
    sell_in = sales.join_header(v.order_lines, v.orders).filter(sales.is_reportable())
    monthly = sell_in.groupBy("distributor_id", month_of(F.col("order_date")).alias("month_start")).agg(
        F.sum("qty_cases").alias("cases")
    )
    spike = F.col("month_start").isin("2000-10-01", "2000-11-01")
    usual = F.col("month_start").between("2000-01-01", "2000-09-01")
    return stories.spike_ratio(monthly, "distributor_id", "cases", spike, usual)


@query
def story_checks(v):
    bridge = marts.growth_bridge(monthly_of(v, sales.COST), LAST_MONTH)
    year = lambda y, c: F.max(F.when(F.col("year") == y, F.col(c)))
    return stories.story_checks(
        bridge,
        [
            ("price driven, volume down in 1998", (year(1998, "pricing_pct") > 0) & (year(1998, "rig_pct") < 0)),
            ("volume recovers in 2000", year(2000, "rig_pct") > 0),
            ("currency effect below one point in 1999", F.abs(year(1999, "fx_effect_pct")) < 1),
        ],
    )


# quality --------------------------------------------------------------------------------------------------------------


@query
def ean13_check(v):
    codes = v.sellout_raw.select(barcode(F.col("ean_raw")).alias("ean"))
    return codes.groupBy("ean", ean13_valid(F.col("ean")).alias("is_valid")).agg(F.count(F.lit(1)).alias("rows"))


@query
def dq_sales(v):
    lines = lines_of(v)
    checks = quality.run_checks(lines, quality.sales_checks())
    return rounded(checks.unionByName(quality.orphan_check(v.order_lines, v.orders)))


@query
def dq_sellout(v):
    # parsed once, counted and cleaned from the stored rows
    conformed = pin(conformed_of(v), "conformed")
    return rounded(quality.sellout_checks(conformed, sellout.weekly_sellout(sellout.valid_rows(conformed))))


@query
def dq_master(v):
    products = v.products
    ean = quality.condition_check("silver", "products", "ean13_check_digit", ~ean13_valid(F.col("ean")))
    unique = quality.unique_check("silver", "products", "unique_ean", ["ean"])
    weight = quality.condition_check("silver", "products", "positive_weight", F.col("case_weight_kg") <= 0)
    prices = lookup.contiguity(v.price_list, ["sku"])
    gap = quality.condition_check("silver", "price_list", "contiguous_intervals", ~F.col("is_contiguous"))
    price = quality.condition_check("silver", "price_list", "positive_price", F.col("list_price_case") <= 0)
    distributor = quality.condition_check(
        "silver", "customers", "distributors_in_one_channel", F.col("is_distributor") & (F.col("channel") != "Traditional trade")
    )
    rows = quality.run_checks(products, [ean, unique, weight]).unionByName(quality.run_checks(prices, [gap, price]))
    return rounded(rows.unionByName(quality.run_checks(v.customers, [distributor])))


def _pos_batch(v: DriverViews) -> tuple[DataFrame, DataFrame]:
    """Events as one batch: raw rows and each event once."""
    raw = v.pos_events.withColumns(
        {
            "_source_file": F.concat(F.lit("date="), F.col("file_date").cast("string")),
            "_ingested_at": F.lit(None).cast("timestamp"),
        }
    )
    return raw, dedup.dedup_exact(pos.conform_events(raw), ["event_id"])


@query
def dq_events(v):
    return rounded(quality.event_checks(*_pos_batch(v)))


# reconciliation ---------------------------------------------------------------------------------------------------------


def _altered(orders: DataFrame) -> DataFrame:
    return orders.withColumn("order_status", F.when(F.col("order_id") % 1000 == 0, "Changed").otherwise(F.col("order_status")))


@query
def content_checksum(v):
    one = lambda name, df: df.agg(portable_checksum(df.columns).alias("checksum")).select(F.lit(name).alias("t"), "checksum")
    both = one("orders", v.orders).unionByName(one("altered", _altered(v.orders)))
    return both.select("t", F.col("checksum").cast("string").alias("checksum"))


@query
def content_checksum_fast(v):
    """The 64-bit hash has no counterpart elsewhere; order and layout of the rows must not matter."""
    shuffled = v.orders.repartition(7, "customer_id")
    pairs = {"orders": (v.orders, shuffled), "altered": (v.orders, _altered(v.orders))}
    return reconcile.reconcile_tables(pairs, checksum).select("check_level", "object_name", "status")


@query
def reconcile_counts(v):
    lines = v.order_lines.select("order_id", "line_no", "sku", "qty_cases", "net_amount")
    pairs = {
        "orders": (v.orders, tables.with_provenance(v.orders, "copy")),
        "orders_altered": (v.orders, _altered(v.orders)),
        "lines_short": (lines, lines.filter("order_id % 1000 <> 0")),
    }
    found = reconcile.reconcile_tables(pairs, portable_checksum)
    texts = {c: F.col(c).cast("decimal(38,0)").cast("string") for c in ("source_value", "target_value", "difference")}
    return found.withColumns(texts)


@query
def reconcile_totals(v):
    source = sales.join_header(v.order_lines, v.orders).filter(sales.is_reportable()).withColumn("year", F.year("order_date"))
    fact = sales.fact_sales(lines_of(v)).filter("order_id % 1000 <> 3").withColumn("year", F.year("order_date"))
    target = fact.select("year", "currency", F.col("net_amount_lc").alias("net_amount"), "qty_cases")
    measures = {"net_sales_local_currency": (F.sum("net_amount"), 0.01), "cases": (F.sum("qty_cases"), 0.0)}
    return reconcile.reconcile_totals(source, target, ["year", "currency"], measures)


@query
def naive_gap(v):
    lines = sales.join_header(v.order_lines, v.orders.filter("currency = 'EUR'"))
    return reconcile.naive_gap(lines, sales.is_reportable(), "net_amount")


@query
def check_log_of_runs(v):
    """The engine's own checks of two runs appended to one log; the rows of the newest run, without its time."""
    path = scratch(v.spark, "dq-results")
    started = runlog.utc_now()
    for run, checks in enumerate((quality.event_checks(*_pos_batch(v)), quality.orphan_check(v.order_lines, v.orders))):
        tables.append_table(runlog.stamped(checks, f"run-{run}", started + dt.timedelta(seconds=run)), path)
    newest = dedup.rows_of_newest_run(v.spark.read.parquet(path), "checked_at")
    return rounded(newest.drop("checked_at"))


@query
def dim_bridge_step(v):
    """Bridge steps with the years they are shown for."""
    years = v.order_span.select(F.explode(F.sequence(F.year("first_day"), F.year("last_day"))).alias("year"))
    return years.join(F.broadcast(marts.dim_bridge_step(v.spark)))


@query
def pass_rate(v):
    return reconcile.pass_rate(v.check_log)


# operations -------------------------------------------------------------------------------------------------------------


@query
def latest_run(v):
    return runlog.flag_latest(v.run_log, v.run_log, "started_at", 600)


@query
def latest_status(v):
    return runlog.latest_status(v.run_log, "snapshot").select(
        "target_table", "run_id", "rows_written", "duration_s", "status", "ended_at"
    )


@query
def run_log_rows(v):
    path = scratch(v.spark, "run-log")
    for layer in ("bronze", "silver", "gold", "ops"):
        tables.append_table(v.run_log.filter(F.col("layer") == layer), path)
    return v.spark.read.parquet(path)


def _counted(v: DriverViews) -> DataFrame:
    joined = sales.join_header(v.order_lines, v.orders)
    return marts.table_counts(
        {
            **{("bronze", t): v.table(t) for t in ("orders", "lineitem", "customer", "part", "events")},
            ("silver", "sales_order_lines"): joined,
            ("silver", "customers_scd2"): v.customers_scd2,
            ("gold", "fact_sales"): sales.reportable(joined),
        }
    )


@query
def table_counts(v):
    return _counted(v)


# measures ---------------------------------------------------------------------------------------------------------------


@query
def kpi_sales(v):
    return rounded(kpi.sales_kpis(stored_monthly_of(v), ["country_code"]))


@query
def kpi_sales_monthly(v):
    return rounded(kpi.sales_kpis(stored_monthly_of(v), ["category"], month_of))


@query
def kpi_star(v):
    dims = {
        "country_code": (v.countries.join(v.regions, "country_code"), "country_code", ["region"]),
        "sku": (v.products, "sku", ["brand"]),
    }
    return rounded(kpi.sales_kpis(kpi.star(stored_monthly_of(v), dims), ["region", "brand"]))


@query
def kpi_bridge_steps(v):
    return rounded(kpi.bridge_steps(kpi.sales_kpis(stored_monthly_of(v), ["category"]), ["category", "period"]))


@query
def kpi_share(v):
    sums = kpi.sales_kpis(stored_monthly_of(v), ["channel"]).select("channel", "period", "net_sales")
    return rounded(kpi.share_of_total(sums, ["period"], "net_sales", "share"))


@query
def kpi_forecast(v):
    return rounded(kpi.forecast_kpis(forecast.seasonal_naive(features_of(v)), ["category"]))


#: What the monthly mart and the weekly sell-in read of the order lines.
SELL_IN_COLUMNS = [
    "order_date",
    "country_code",
    "channel",
    "sku",
    "category",
    "qty_cases",
    "volume_kg",
    "currency",
    "net_amount_lc",
    "gross_amount_eur",
    "net_amount_eur",
    "is_promo",
    "order_status",
    "is_deleted",
    "distributor_id",
]


@query
def kpi_sellout(v):
    # order lines feed both marts: written once, read twice
    lines = pin(lines_of(v, sales.COST).select(*SELL_IN_COLUMNS), "sell-in")
    monthly = pin(marts.mart_sales_monthly(lines, v.fx, BASE_YEAR), "sales-monthly")
    return rounded(kpi.sellout_kpis(sellin_sellout_of(v, lines), monthly, ["country_code"]))


@query
def kpi_stock_cover_top12(v):
    mart = pin(sellin_sellout_of(v))
    return rounded(kpi.stock_cover_top(mart), 4)


def _joined_members(df: DataFrame) -> DataFrame:
    """Lists of members as text, for comparison with another engine."""
    return rounded(df.withColumn("members", F.array_join("members", " | ")))


#: What the slicers of the report's pages select here.
SELECTED_YEARS = (1997, 1998)
SELECTED = {"country_code": ("1", "3", "7", "12", "20"), "category": ("ECONOMY", "PROMO", "SMALL", "STANDARD"), "channel": ("BUILDING", "FURNITURE", "MACHINERY")}
SALES_SLICES = (
    kpi.Slice("total"),
    kpi.Slice("month", monthly=True),
    kpi.Slice("category", ("category",)),
    kpi.Slice("country", ("country_code",)),
    kpi.Slice("channel", ("channel",)),
    kpi.Slice("channel by month", ("channel", "category"), monthly=True),
)
SELLOUT_SLICES = (kpi.Slice("month", monthly=True), kpi.Slice("distributor", ("distributor_name",)), kpi.Slice("country and category", ("country_code", "category")))


@query
def kpi_sales_page(v):
    mart = stored_monthly_of(v)
    return _joined_members(kpi.sales_page(mart, SALES_SLICES, kpi.Selection(SELECTED, SELECTED_YEARS)))


@query
def kpi_sellout_page(v):
    lines = pin(lines_of(v, sales.COST).select(*SELL_IN_COLUMNS), "sell-in")
    monthly = pin(marts.mart_sales_monthly(lines, v.fx, BASE_YEAR), "sales-monthly")
    chosen = kpi.Selection({c: SELECTED[c] for c in ("category",)}, SELECTED_YEARS)
    return _joined_members(kpi.sellout_page(sellin_sellout_of(v, lines), monthly, SELLOUT_SLICES, chosen))


@query
def kpi_promo_uplift(v):
    return rounded(kpi.promo_kpis(promo_of(v), ["category"]))


@query
def kpi_platform(v):
    return rounded(runlog.platform_kpis(v.run_log, v.check_log, _counted(v), "snapshot", 600))


@query
def kpi_rows_top12(v):
    sizes = v.run_log.groupBy("target_table").agg(F.sum("rows_written").alias("row_count"))
    top = kpi.top_ranked(sizes, "row_count")
    return top.withColumn("rows_m", F.col("row_count") / 1e6)


@query
def kpi_latest_detail(v):
    return dedup.rows_of_newest_run(v.check_log, "checked_at")


# ingestion --------------------------------------------------------------------------------------------------------------


@query
def ingest_snapshot(v):
    root = scratch(v.spark, "snapshot")
    sources = {"orders": lambda: v.orders, "customers": lambda: v.customers}
    tables.snapshot_all(v.spark, sources, root, "source", "run", f"{root}/ops/run_log")
    stored = v.spark.read.parquet(tables.table_path(root, "bronze", "orders"))
    return reconcile.drop_technical(stored)


def _ingest_csv(v: DriverViews, layout: str, schema: str, sep: str) -> str:
    """Write one layout as delimited files, ingest them as a stream, return the table's path."""
    root = scratch(v.spark, f"sellout-{layout}")
    frame = _layout_frames(v)[layout].drop("_source_file")
    named = frame.selectExpr(*[f"`{c}`" if c in frame.columns else f"'' AS `{c}`" for c in _columns(schema)])
    options = {"header": True, "sep": sep, "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    named.write.options(**options).csv(f"{root}/landing")
    stream = ingest.csv_stream(v.spark, f"{root}/landing", schema, "part-*.csv", sep)
    ingest.run_available_now(stream, f"{root}/table", f"{root}/checkpoint")
    return f"{root}/table"


def _columns(schema: str) -> list[str]:
    return [part.split()[0] for part in schema.split(", ")]


@query
def ingest_files_csv(v):
    stored = {}
    for layout, schema, sep in (("A", SELLOUT_A, ";"), ("B", SELLOUT_B, ",")):
        stored[layout] = v.spark.read.parquet(_ingest_csv(v, layout, schema, sep))
    return sellout.unify_layouts(**stored).drop("_source_file").fillna("")


@query
def ingest_files_json(v):
    root = scratch(v.spark, "sellout-json")
    names = sellout.LAYOUTS["JSON"].columns
    rows = v.sellout_raw.filter("layout = 'JSON'")
    record = F.struct(*[F.col(r).alias(c) for r, c in zip(sellout.RAW_COLUMNS[1:8], names, strict=True)])
    # a document holds the rows of at most fifty orders
    chunk = F.floor(F.col("_order") / 50)
    documents = rows.groupBy(F.col("distributor_raw").alias("distributor"), chunk.alias("chunk")).agg(
        F.collect_list(record).alias("records")
    )
    documents.select(F.to_json(F.struct("distributor", "records")).alias("value")).write.text(f"{root}/landing")
    stream = ingest.json_records_stream(v.spark, f"{root}/landing", SELLOUT_JSON, "part-*.txt", multi_line=False)
    ingest.run_available_now(stream, f"{root}/table", f"{root}/checkpoint")
    return v.spark.read.parquet(f"{root}/table").select("distributor", *names)


@query
def layout_counts(v):
    paths = {layout: _ingest_csv(v, layout, schema, sep) for layout, schema, sep in (("A", SELLOUT_A, ";"), ("B", SELLOUT_B, ","))}
    return ingest.layout_counts(v.spark, paths).select("layout", "rows")


# events -----------------------------------------------------------------------------------------------------------------


def _land_events(v: DriverViews) -> str:
    """Events as JSON lines in ``date=`` folders."""
    landing = f"{scratch(v.spark, 'pos')}/landing"
    fields = [*_columns(POS_EVENT), "device"]
    lines = v.pos_events.select(F.to_json(F.struct(*fields)).alias("value"), F.col("file_date").alias("date"))
    # few files per day, and a busy day is split
    lines.hint("rebalance", "date").write.partitionBy("date").text(landing)
    return landing


def _upserted(v: DriverViews, max_files: int | None = None) -> DataFrame:
    landing = _land_events(v)
    root = scratch(v.spark, "pos-tables")
    stream = pos.read_event_stream(pos.disk_state_session(v.spark), landing, max_files=max_files)
    pos.run_upsert(stream, f"{root}/bronze", f"{root}/silver", f"{root}/checkpoint")
    return event_table.read_events(v.spark, f"{root}/silver")


@query
def pos_compacted(v):
    """The event table while it is written in small batches and compacted in between, read in three states."""
    landing, root = _land_events(v), scratch(v.spark, "pos-compacted")
    silver = f"{root}/silver"
    stream = pos.read_event_stream(pos.disk_state_session(v.spark), landing, max_files=12)
    pos.run_upsert(stream, f"{root}/bronze", silver, f"{root}/checkpoint")
    counts = None
    for state, step in (("before", None), ("after", event_table.compact), ("cleaned", event_table.vacuum)):
        if step:
            step(v.spark, silver)
        rows = event_table.read_events(v.spark, silver).groupBy("event_date", "country").agg(F.count(F.lit(1)).alias("n"))
        one = pin(rows.withColumn("state", F.lit(state)), "counted")
        counts = one if counts is None else counts.unionByName(one)
    states = [F.sum(F.when(F.col("state") == s, F.col("n"))).alias(s) for s in ("before", "after", "cleaned")]
    return counts.groupBy("event_date", "country").agg(*states)


POS_COLUMNS = [c for c in pos.SILVER_COLUMNS if not c.startswith("_")]


@query
def pos_events(v):
    return _upserted(v, max_files=20).select(*POS_COLUMNS)


@query
def pos_events_stateful(v):
    root = scratch(v.spark, "pos-stateful")
    session = pos.disk_state_session(v.spark)
    stream = pos.dedup_events(pos.conform_events(pos.read_event_stream(session, _land_events(v))))
    ingest.run_available_now(stream, f"{root}/silver", f"{root}/checkpoint")
    return v.spark.read.parquet(f"{root}/silver").select(*POS_COLUMNS)


@query
def pos_late(v):
    return _upserted(v).filter("is_late").select("event_id", "event_date", "file_date", "device")


@query
def pos_summary(v):
    folder = F.regexp_extract("_source_file", pos.FILE_DATE, 1)
    return pos.stream_summary(_upserted(v).withColumn("_source_file", folder))


@query
def pos_daily(v):
    return marts.mart_pos_daily(_pos_batch(v)[1], v.products.select("ean", "category"), v.event_fx)


# forecast ---------------------------------------------------------------------------------------------------------------


@query
def lag_features(v):
    return rounded(features_of(v))


@query
def seasonal_naive(v):
    return forecast.seasonal_naive(features_of(v))


@query
def forecast_metrics(v):
    return forecast.forecast_accuracy(forecast.seasonal_naive(features_of(v)))


# governance -------------------------------------------------------------------------------------------------------------


@query
def row_filter(v):
    lines = sales.join_header(v.order_lines, v.orders).join(
        v.customers.select("customer_id", "country_code"), "customer_id"
    )
    seen = governance.row_filter(lines, v.country_access, USER)
    return seen.groupBy("country_code").agg(F.count(F.lit(1)).alias("lines"), F.sum("net_amount").alias("net_amount"))


@query
def mask_pii(v):
    columns = ["contact_name", "contact_email", "contact_phone", "vat_number"]
    shown = governance.mask_columns(v.customers, columns, v.pii_readers, USER)
    return shown.select("customer_id", "customer_name", *columns)


@query
def visibility(v):
    sold = v.orders.join(v.order_lines, "order_id").join(v.customers.select("customer_id", "country_code"), "customer_id")
    per_country = sold.groupBy("country_code").agg(F.sum("net_amount").alias("net_amount"))
    before = governance.grant(v.country_access, USER, "ALL")
    after = governance.grant(before, USER, "5")
    found = None
    for label, access in (("all", before), ("one country", after)):
        one = governance.visibility(governance.row_filter(per_country, access, USER), "net_amount").select(
            F.lit(label).alias("access"), "countries_visible", "net_sales_eur_m", "first_country"
        )
        found = one if found is None else found.unionByName(one)
    return found


@query
def clustered_write(v):
    path = f"{scratch(v.spark, 'clustered')}/orders"
    tables.write_clustered(v.orders, path, "order_date")
    window = v.spark.read.parquet(path).filter(F.col("order_date").between("1997-01-01", "1997-03-31"))
    return window.groupBy("order_date").agg(F.count(F.lit(1)).alias("orders"), count_where(F.col("is_deleted")).alias("deleted"))
