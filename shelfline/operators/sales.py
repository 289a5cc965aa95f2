"""Sell-in: order lines, returns, promotions and the sales fact."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.functions.numbers import WEIGHT, money, to_base_currency
from shelfline.operators.lookup import join_fx, join_standard_cost, pit_join

CANCELLED = "Cancelled"

# Columns of the sales fact.
FACT_COLUMNS = [
    "order_id",
    "line_no",
    "order_date",
    "customer_id",
    "customer_sk",
    "country_code",
    "channel",
    "sku",
    "product_sk",
    "category",
    "qty_cases",
    "volume_kg",
    "currency",
    "net_amount_lc",
    "gross_amount_eur",
    "net_amount_eur",
    "cogs_eur",
    "is_promo",
    "promo_id",
]

#: What can be left out of the order lines: the version of the customer, and the standard cost.
CUSTOMER, COST = "customer", "cost"


def is_reportable() -> Column:
    """Neither deleted nor cancelled; open orders count."""
    return ~F.col("is_deleted") & (F.col("order_status") != CANCELLED)


def reportable(df: DataFrame) -> DataFrame:
    return df.filter(is_reportable())


def sales_order_lines(
    lines: DataFrame,
    orders: DataFrame,
    customers: DataFrame,
    products: DataFrame,
    fx: DataFrame,
    cost: DataFrame,
    without: Collection[str] = (),
) -> DataFrame:
    """Order lines with header, customer and product version of the order date, rate and standard cost.

    Everything that depends on the header alone is attached to the headers, several times fewer than the
    lines, so the lines are shuffled once by order and once by SKU (versions and cost share that shuffle).
    Cancelled and deleted orders stay, flagged.  ``without`` names parts nobody reads (a left join that is not
    known to be unique cannot be dropped by the optimizer): their columns and joins are left out.
    """
    headers = orders.select(
        "order_id",
        "customer_id",
        F.col("order_date").cast("date").alias("order_date"),
        "currency",
        "order_status",
        F.col("sales_channel").alias("channel"),
        F.col("is_deleted").cast("boolean").alias("is_deleted"),
    )
    # the date is compared as midnight: an order on the day of a 14:00 change belongs to the old version
    version = {} if CUSTOMER in without else {"customer_sk": "customer_sk", "country_code": "country_code"}
    if version:
        headers = pit_join(headers, customers, "customer_id", F.col("order_date"), version)
    headers = join_fx(headers, fx, "order_date")
    joined = join_header(lines, headers)
    product = {"product_sk": "product_sk", "category": "category", "subcategory": "subcategory", "brand": "brand"}
    joined = pit_join(joined, products, "sku", F.col("order_date"), product | {"case_weight_kg": "case_weight_kg"})
    if COST not in without:
        joined = join_standard_cost(joined, cost, "order_date")
    qty = F.col("qty_cases")
    gross = qty * F.col("list_price_case")
    return joined.select(
        "order_id",
        "line_no",
        "order_date",
        "customer_id",
        *version,
        "channel",
        "sku",
        *product,
        qty.cast("int").alias("qty_cases"),
        "currency",
        F.col("list_price_case").cast("decimal(12,2)").alias("list_price_case"),
        F.col("discount_pct").cast("decimal(6,4)").alias("discount_pct"),
        money(gross).alias("gross_amount_lc"),
        money(F.col("net_amount")).alias("net_amount_lc"),
        "rate_per_eur",
        to_base_currency(gross, F.col("rate_per_eur")).alias("gross_amount_eur"),
        to_base_currency(F.col("net_amount"), F.col("rate_per_eur")).alias("net_amount_eur"),
        *([] if COST in without else [money(qty * F.col("std_cost_eur_case")).alias("cogs_eur")]),
        (qty * F.col("case_weight_kg")).cast(WEIGHT).alias("volume_kg"),
        "promo_id",
        F.col("promo_id").isNotNull().alias("is_promo"),
        "order_status",
        "is_deleted",
        *[c for c in ("distributor_id",) if c in lines.columns],
    )


def join_header(lines: DataFrame, headers: DataFrame) -> DataFrame:
    """Lines with their header, inner: lines without one vanish and are counted by the checks."""
    return lines.join(headers, "order_id")


def fact_sales(lines: DataFrame) -> DataFrame:
    return reportable(lines).select(*FACT_COLUMNS)


def returns_eur(returns: DataFrame, orders: DataFrame, fx: DataFrame) -> DataFrame:
    """Returns at the rate of the return date, in the currency of the order."""
    typed = returns.select(
        "return_id",
        "order_id",
        "line_no",
        F.col("return_date").cast("date").alias("return_date"),
        F.col("qty_cases").cast("int").alias("qty_cases"),
        "reason_code",
        money(F.col("credit_amount")).alias("credit_amount_lc"),
    )
    joined = join_fx(typed.join(orders.select("order_id", "currency"), "order_id"), fx, "return_date")
    credit = to_base_currency(F.col("credit_amount_lc"), F.col("rate_per_eur"))
    return joined.select(*typed.columns, "currency", credit.alias("credit_amount_eur"))


def typed_promotions(raw: DataFrame) -> DataFrame:
    return raw.select(
        "promo_id",
        "customer_id",
        "category",
        "mechanic",
        F.col("discount_pct").cast("decimal(5,4)").alias("discount_pct"),
        F.col("start_date").cast("date").alias("start_date"),
        F.col("end_date").cast("date").alias("end_date"),
        F.col("duration_weeks").cast("int").alias("duration_weeks"),
        F.col("planned_uplift_pct").cast("decimal(6,1)").alias("planned_uplift_pct"),
    )


def sales_yearly(lines: DataFrame) -> DataFrame:
    """Plausibility table: lines, net sales, volume and margin per year."""
    by_year = reportable(lines).groupBy(F.year("order_date").alias("year")).agg(
        F.count(F.lit(1)).alias("order_lines"),
        F.sum("net_amount_eur").cast("double").alias("net"),
        F.sum("volume_kg").cast("double").alias("kg"),
        F.sum("cogs_eur").cast("double").alias("cogs"),
    )
    return by_year.select(
        "year",
        "order_lines",
        F.round(F.col("net") / 1e6, 1).alias("net_sales_eur_m"),
        F.round(F.col("kg") / 1e6, 1).alias("volume_kt"),
        F.round(100 * (1 - F.try_divide("cogs", "net")), 1).alias("gross_margin_pct"),
    )
