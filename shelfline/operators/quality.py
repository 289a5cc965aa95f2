"""Data-quality expectations: one row per check, all counters of a table in one aggregate."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.functions.numbers import count_where
from shelfline.operators.dedup import distinct_count, newest_per_key


@dataclass(frozen=True)
class Check:
    """``failed`` and ``total`` are aggregates over the table the check runs on."""

    layer: str
    table: str
    name: str
    failed: Column
    total: Column | None = None
    threshold_pct: float = 0.0


def run_checks(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """Evaluate checks on one frame in a single pass and return one row each."""
    counters = []
    for i, check in enumerate(checks):
        counters.append(F.coalesce(check.failed, F.lit(0)).cast("long").alias(f"f{i}"))
        total = F.count(F.lit(1)) if check.total is None else check.total
        counters.append(F.coalesce(total, F.lit(0)).cast("long").alias(f"t{i}"))
    rows = F.array(
        *[
            F.struct(
                F.lit(c.layer).alias("layer"),
                F.lit(c.table).alias("table_name"),
                F.lit(c.name).alias("check_name"),
                F.col(f"f{i}").alias("failed_rows"),
                F.col(f"t{i}").alias("total_rows"),
                F.lit(float(c.threshold_pct)).alias("threshold_pct"),
            )
            for i, c in enumerate(checks)
        ]
    )
    return judge(df.agg(*counters).select(F.inline(rows)))


def judge(counted: DataFrame) -> DataFrame:
    """Failed share and verdict; an empty total passes, the threshold itself passes."""
    pct = F.coalesce(F.try_divide(100.0 * F.col("failed_rows"), F.col("total_rows")), F.lit(0.0))
    status = F.when(F.col("failed_pct") <= F.col("threshold_pct"), "PASS").otherwise("FAIL")
    return counted.withColumn("failed_pct", pct).withColumn("status", status).select(
        "layer", "table_name", "check_name", "failed_rows", "total_rows", "failed_pct", "threshold_pct", "status"
    )


def null_check(layer: str, table: str, name: str, column: str, threshold_pct: float = 0.0) -> Check:
    return Check(layer, table, name, count_where(F.col(column).isNull()), threshold_pct=threshold_pct)


def condition_check(layer: str, table: str, name: str, bad: Column, threshold_pct: float = 0.0) -> Check:
    return Check(layer, table, name, count_where(bad), threshold_pct=threshold_pct)


def unique_check(layer: str, table: str, name: str, columns: Sequence[str], threshold_pct: float = 0.0) -> Check:
    failed = F.count(F.lit(1)) - distinct_count(columns)
    return Check(layer, table, name, failed, threshold_pct=threshold_pct)


def sales_checks(table: str = "sales_order_lines") -> list[Check]:
    layer = "silver"
    return [
        unique_check(layer, table, "unique_order_line", ["order_id", "line_no"]),
        null_check(layer, table, "missing_fx", "net_amount_eur"),
        null_check(layer, table, "missing_product_version", "product_sk"),
        null_check(layer, table, "missing_customer_version", "customer_sk"),
        null_check(layer, table, "missing_standard_cost", "cogs_eur"),
        condition_check(layer, table, "non_positive_qty", F.col("qty_cases") <= 0),
        condition_check(layer, table, "soft_deleted_orders_flagged", F.col("is_deleted"), 1.0),
        condition_check(layer, table, "cancelled_orders_flagged", F.col("order_status") == "Cancelled", 2.0),
    ]


def orphan_check(lines: DataFrame, orders: DataFrame, table: str = "sales_order_lines") -> DataFrame:
    """Lines without a header among all lines."""
    heads = orders.select(F.col("order_id"), F.lit(1).alias("_head")).distinct()
    flagged = lines.select("order_id").join(heads, "order_id", "left")
    return run_checks(flagged, [null_check("silver", table, "orphan_lines_without_header", "_head")])


def sellout_checks(conformed: DataFrame, clean: DataFrame, table: str = "sellout_weekly") -> DataFrame:
    """Rejected share, removed copies and uniqueness.  Clean rows arrive de-duplicated."""
    counted = conformed.agg(
        count_where(F.col("reject_reason").isNotNull()).alias("rejected"), F.count(F.lit(1)).alias("total")
    )
    kept = clean.agg(
        F.count(F.lit(1)).alias("kept"), distinct_count(["distributor_id", "week_ending", "sku"]).alias("keys")
    )
    # two one-row frames side by side
    both = counted.crossJoin(kept)
    valid = F.col("total") - F.col("rejected")

    def row(name: str, failed: Column, total: Column, threshold: float) -> Column:
        return F.struct(
            F.lit("silver").alias("layer"),
            F.lit(table).alias("table_name"),
            F.lit(name).alias("check_name"),
            failed.alias("failed_rows"),
            total.alias("total_rows"),
            F.lit(threshold).alias("threshold_pct"),
        )

    rows = F.array(
        row("rows_rejected_with_reason", F.col("rejected"), F.col("total"), 2.0),
        row("duplicate_rows_removed", valid - F.col("kept"), valid, 2.0),
        row("unique_distributor_week_sku", F.col("kept") - F.col("keys"), F.col("kept"), 0.0),
    )
    return judge(both.select(F.inline(rows)))


def event_checks(raw: DataFrame, clean: DataFrame, table: str = "pos_events") -> DataFrame:
    """Removed copies, late share and uniqueness of the event id."""
    clean_counts = clean.agg(
        F.count(F.lit(1)).alias("kept"),
        count_where(F.col("is_late")).alias("late"),
        F.countDistinct("event_id").alias("ids"),
    )
    both = raw.agg(F.count(F.lit(1)).alias("received")).crossJoin(clean_counts)

    def row(name: str, failed: Column, total: str, threshold: float) -> Column:
        return F.struct(
            F.lit("silver").alias("layer"),
            F.lit(table).alias("table_name"),
            F.lit(name).alias("check_name"),
            failed.alias("failed_rows"),
            F.col(total).alias("total_rows"),
            F.lit(threshold).alias("threshold_pct"),
        )

    rows = F.array(
        row("duplicate_events_removed", F.col("received") - F.col("kept"), "received", 1.0),
        row("late_events_flagged", F.col("late"), "kept", 2.0),
        row("unique_event_id", F.col("kept") - F.col("ids"), "kept", 0.0),
    )
    return judge(both.select(F.inline(rows)))


def log_matches_current(log: DataFrame, current: DataFrame, key: str, fields: Sequence[str]) -> DataFrame:
    """Per field: entities whose newest logged value differs from today's value (NULL equals NULL)."""
    tracked = log.filter(F.col("field_name").isin(*fields))
    newest = newest_per_key(
        tracked.select(key, "field_name", "new_value", "changed_at", "change_id"), [key, "field_name"], ["changed_at", "change_id"]
    )
    today = current.select(
        key, F.inline(F.array(*[F.struct(F.lit(f).alias("field_name"), F.col(f).cast("string").alias("today")) for f in fields]))
    )
    compared = newest.join(today, [key, "field_name"])
    return compared.groupBy("field_name").agg(
        F.count(F.lit(1)).alias("total_rows"), count_where(~F.col("new_value").eqNullSafe(F.col("today"))).alias("failed_rows")
    )
