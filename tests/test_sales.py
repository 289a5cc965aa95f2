import datetime as dt

from conftest import at, day, rows
from pyspark.sql import functions as F

from shelfline.operators import quality, reconcile, sales, series
from shelfline.plans import kpi, marts, stories


def fx_of(spark, published):
    return series.fx_daily(spark.createDataFrame(published, "rate_date date, currency string, rate_per_eur double"))


def test_fx_is_filled_forward_with_flag_and_base(spark):
    fx = fx_of(spark, [(day("2025-01-03"), "PLN", 4.0), (day("2025-01-06"), "PLN", 4.2), (day("2025-01-06"), "SEK", 11.0)])
    assert rows(fx) == sorted(
        [(day(f"2025-01-0{d}"), "EUR", 1.0, False) for d in (3, 4, 5, 6)]
        + [(day("2025-01-03"), "PLN", 4.0, False), (day("2025-01-04"), "PLN", 4.0, True), (day("2025-01-05"), "PLN", 4.0, True), (day("2025-01-06"), "PLN", 4.2, False)]
        + [(day(f"2025-01-0{d}"), "SEK", None, True) for d in (3, 4, 5)]
        + [(day("2025-01-06"), "SEK", 11.0, False)],
        key=str,
    )
    assert rows(series.published_average(fx, 2025)) == [("EUR", 1.0), ("PLN", 4.1), ("SEK", 11.0)]


def test_inflation_counts_rows_not_months(spark):
    months = [f"{2023 + i // 12}-{i % 12 + 1:02d}" for i in range(26) if i != 4]
    raw = spark.createDataFrame([("PL", m, str(100 + i), "s") for i, m in enumerate(months)], "country_code string, month string, index_value string, source string")
    found = sorted(rows(series.inflation_monthly(raw), "month", "food_inflation_yoy_pct"), key=lambda r: r[0])
    assert [p for _, p in found[:12]] == [None] * 12
    # a missing month shifts the comparison by one month
    assert found[12] == (day("2024-02-01"), 12.0)


def price(spark):
    index = spark.createDataFrame(
        [("A", day("2020-12-01"), 100.0), ("A", day("2021-03-01"), 110.0), ("B", day("2020-12-01"), 200.0), ("B", day("2021-03-01"), 230.0)],
        "country_code string, month date, index_value double",
    )
    rounds = spark.createDataFrame([(day("2021-01-01"),), (day("2021-07-01"),)], "valid_from date")
    countries = spark.createDataFrame([("A",), ("B",), ("C",)], "country_code string")
    return series.price_factor(index, rounds, countries, F.lit("2020-12-01").cast("date"), 0.5)


def test_price_factor_uses_last_known_index_and_mean_for_missing_country(spark):
    found = {(r.country_code, str(r.valid_from)): r.price_factor for r in price(spark).collect()}
    assert found[("A", "2021-01-01")] == 1.0
    assert found[("A", "2021-07-01")] == 1.05
    assert found[("C", "2021-07-01")] == round(1 + 0.5 * (170 / 150 - 1), 6)


def sample_lines(spark):
    end = at("9999-12-31")
    orders = spark.createDataFrame(
        [(1, "c1", day("2025-01-03"), "PLN", "Invoiced", "Web", False), (2, "c1", day("2025-02-03"), "EUR", "Cancelled", "Web", False),
         (3, "c1", day("2025-02-03"), "EUR", "Open", "Web", True), (4, "c9", day("2025-02-04"), "EUR", "Open", "Web", False)],
        "order_id bigint, customer_id string, order_date date, currency string, order_status string, sales_channel string, is_deleted boolean",
    )
    lines = spark.createDataFrame(
        [(1, 1, 7, 10, "2.50", "0.1000", "22.50", "P1"), (1, 1, 7, 10, "2.50", "0.1000", "22.50", None), (2, 1, 7, 1, "5.00", "0.0", "5.00", None),
         (3, 1, 7, 1, "5.00", "0.0", "5.00", None), (4, 1, 8, 2, "1.00", "0.0", "2.00", None), (99, 1, 7, 1, "1.00", "0.0", "1.00", None)],
        "order_id bigint, line_no int, sku int, qty_cases int, list_price_case string, discount_pct string, net_amount string, promo_id string",
    ).withColumns({c: F.col(c).cast(t) for c, t in (("list_price_case", "decimal(12,2)"), ("discount_pct", "decimal(6,4)"), ("net_amount", "decimal(14,2)"))})
    customers = spark.createDataFrame([("c1", 11, "PL", at("2020-01-01"), end)], "customer_id string, customer_sk bigint, country_code string, valid_from timestamp, valid_to timestamp")
    products = spark.createDataFrame(
        [(7, 70, "Coffee", "s", "b", 1.5, at("2015-01-01"), end)],
        "sku int, product_sk bigint, category string, subcategory string, brand string, case_weight_kg double, valid_from timestamp, valid_to timestamp",
    )
    cost = spark.createDataFrame([(7, "2025Q1", 1.25)], "sku int, fiscal_quarter string, std_cost_eur_case double")
    fx = fx_of(spark, [(day("2025-01-03"), "PLN", 4.0), (day("2025-02-28"), "PLN", 5.0)])
    return lines, orders, sales.sales_order_lines(lines, orders, customers, products, fx, cost), fx


def test_order_lines_amounts_flags_and_missing_lookups(spark):
    _, _, sol, _ = sample_lines(spark)
    found = [tuple(map(str, r)) for r in rows(sol, "order_id", "gross_amount_lc", "net_amount_eur", "cogs_eur", "volume_kg", "country_code", "is_promo")]
    assert found == [
        ("1", "25.00", "5.63", "12.50", "15.000", "PL", "False"),
        ("1", "25.00", "5.63", "12.50", "15.000", "PL", "True"),
        ("2", "5.00", "5.00", "1.25", "1.500", "PL", "False"),
        ("3", "5.00", "5.00", "1.25", "1.500", "PL", "False"),
        ("4", "2.00", "2.00", "None", "None", "None", "False"),
    ]
    assert [r[0] for r in rows(sales.reportable(sol), "order_id")] == [1, 1, 4]


def test_sales_expectations(spark):
    lines, orders, sol, _ = sample_lines(spark)
    checks = quality.run_checks(sol, quality.sales_checks()).unionByName(quality.orphan_check(lines, orders))
    found = {r.check_name: (r.failed_rows, r.total_rows, r.status) for r in checks.collect()}
    assert found["unique_order_line"] == (1, 5, "FAIL")
    assert found["missing_fx"] == (0, 5, "PASS")
    assert found["missing_product_version"] == (1, 5, "FAIL")
    assert found["missing_customer_version"] == (1, 5, "FAIL")
    assert found["missing_standard_cost"] == (1, 5, "FAIL")
    assert found["orphan_lines_without_header"] == (1, 6, "FAIL")


def test_threshold_itself_passes_and_empty_total_passes(spark):
    df = spark.createDataFrame([("l", "t", "at", 1, 100, 1.0), ("l", "t", "over", 2, 100, 1.0), ("l", "t", "none", 0, 0, 0.0)],
                               "layer string, table_name string, check_name string, failed_rows bigint, total_rows bigint, threshold_pct double")
    assert {r.check_name: r.status for r in quality.judge(df).collect()} == {"at": "PASS", "over": "FAIL", "none": "PASS"}
    empty = quality.run_checks(df.filter("false"), [quality.condition_check("l", "t", "c", F.lit(True))])
    assert [(r.failed_rows, r.total_rows, r.status) for r in empty.collect()] == [(0, 0, "PASS")]


def test_monthly_mart_keeps_constant_currency(spark):
    _, _, sol, fx = sample_lines(spark)
    mart = marts.mart_sales_monthly(sol, fx, 2025)
    found = rows(mart, "month_start", "country_code", "cases", "volume_t", "net_sales_eur", "net_sales_cfx_eur", "promo_net_sales_eur", "order_lines")
    assert found == [
        (day("2025-01-01"), "PL", 20, 0.03, 11.26, 10.0, 5.63, 2),
        (day("2025-02-01"), None, 2, None, 2.0, 2.0, 0.0, 1),
    ]


def test_growth_bridge(spark):
    mart = spark.createDataFrame(
        [(day("2024-01-01"), 100e6, 100e6, 10.0), (day("2025-01-01"), 112e6, 110e6, 10.5), (day("2025-12-01"), 1e9, 1e9, 1.0)],
        "month_start date, net_sales_eur double, net_sales_cfx_eur double, volume_t double",
    )
    assert rows(marts.growth_bridge(mart, 9)) == [(2024, 100.0, None, None, None, None), (2025, 112.0, 10.0, 5.0, 5.0, 2.0)]


def test_promotion_baseline(spark):
    weeks = [("2025-01-06", 8), ("2025-02-24", 8), ("2025-03-03", 10), ("2024-12-30", 500)]
    lines = spark.createDataFrame(
        [("C", "Coffee", day(d), n, n * 2.0, n * 1.0, False, "Open") for d, n in weeks],
        "customer_id string, category string, order_date date, qty_cases int, net_amount_eur double, cogs_eur double, is_deleted boolean, order_status string",
    )
    promos = spark.createDataFrame(
        [("P1", "C", "Coffee", "m", "0.2", day("2025-03-03"), day("2025-03-09"), 1, "10.0"), ("P2", "C", "Water", "m", "0.2", day("2025-03-03"), day("2025-03-09"), 1, "10.0"),
         ("P3", "C", "Coffee", "m", "0.2", day("2025-03-03"), day("2025-03-16"), 2, "10.0")],
        "promo_id string, customer_id string, category string, mechanic string, discount_pct string, start_date date, end_date date, duration_weeks int, planned_uplift_pct string",
    )
    customers = spark.createDataFrame([("C", "PL", "Web")], "customer_id string, country_code string, channel string")
    mart = marts.mart_promo_performance(lines, sales.typed_promotions(promos), customers)
    # weeks without sales count as zero; a promotion without any baseline is dropped
    found = {r.promo_id: r for r in mart.collect()}
    assert set(found) == {"P1", "P3"}
    assert (float(found["P1"].baseline_cases), float(found["P1"].uplift_pct)) == (2.0, 400.0)
    assert float(found["P1"].incremental_net_eur) == 16.0 and float(found["P1"].discount_cost_eur) == 5.0
    assert found["P1"].promo_roi == 1.6 and float(found["P3"].baseline_cases) == 4.0


def test_promotion_baseline_ends_with_the_promotion(spark):
    """Sales of ten cases in every week: a promotion that ends eight days before its start has seven baseline weeks."""
    mondays = [day("2025-01-06") + dt.timedelta(weeks=k) for k in range(20)]
    lines = spark.createDataFrame(
        [("C", "Coffee", d, 10, 20.0, 10.0, False, "Open") for d in mondays],
        "customer_id string, category string, order_date date, qty_cases int, net_amount_eur double, cogs_eur double, is_deleted boolean, order_status string",
    )
    start = day("2025-03-10")
    ends = {"week before": start - dt.timedelta(days=8), "same day": start, "long before": start - dt.timedelta(days=90)}
    promos = spark.createDataFrame(
        [(name, "C", "Coffee", "m", "0.2", start, end, 2, "10.0") for name, end in ends.items()],
        "promo_id string, customer_id string, category string, mechanic string, discount_pct string, start_date date, end_date date, duration_weeks int, planned_uplift_pct string",
    )
    customers = spark.createDataFrame([("C", "PL", "Web")], "customer_id string, country_code string, channel string")
    mart = marts.mart_promo_performance(lines, sales.typed_promotions(promos), customers)
    found = {r.promo_id: (float(r.baseline_cases), r.promo_cases) for r in mart.collect()}
    assert found == {"week before": (17.5, None), "same day": (20.0, 10)}


def test_prior_year_compares_the_same_months(spark):
    data = [(day("2023-01-01"), 10.0), (day("2023-02-01"), 90.0), (day("2024-01-01"), 20.0), (day("2024-02-01"), 80.0), (day("2025-01-01"), 30.0)]
    mart = spark.createDataFrame([(d, v, v, v, v / 2) for d, v in data], "month_start date, net_sales_eur double, net_sales_cfx_eur double, volume_t double, cogs_eur double")
    found = {r.period: r for r in kpi.sales_kpis(mart).collect()}
    assert found[2023].net_sales_py is None and found[2023].reported_growth is None
    assert (found[2024].net_sales, found[2024].net_sales_py, found[2024].reported_growth) == (100.0, 100.0, 0.0)
    assert (found[2025].net_sales, found[2025].net_sales_py, found[2025].organic_growth) == (30.0, 20.0, 0.5)
    assert found[2025].organic_growth_py == 1.0 and found[2025].gross_margin == 0.5
    steps = {r.step: r.value_m for r in kpi.bridge_steps(kpi.sales_kpis(mart), ["period"]).filter("period = 2025").collect()}
    assert round(sum(steps.values()) * 1e6, 6) == 30.0
    assert rows(kpi.share_of_total(kpi.sales_kpis(mart).select("period", "net_sales"), [], "net_sales", "s"), "period", "s")[2][1] == 30 / 230


def test_top_list_keeps_ties_and_overstock_flag(spark):
    df = spark.createDataFrame([(f"d{i}", float(min(i, 12))) for i in range(15)], "distributor_name string, v double")
    top = kpi.top_ranked(df, "v", 3)
    assert rows(top, "distributor_name", "rank") == [("d12", 1), ("d13", 1), ("d14", 1)]
    mart = spark.createDataFrame(
        [("a", day("2025-01-05"), 10.0, 2.0), ("a", day("2025-01-12"), None, 9.0), ("b", day("2025-01-05"), 4.0, 2.0)],
        "distributor_name string, week_ending date, stock_cases double, sell_out_4w_avg double",
    )
    found = {r.distributor_name: r for r in kpi.stock_cover_top(mart).collect()}
    assert found["a"].stock_cover == 5.0 and found["b"].network_cover == 3.5
    assert found["a"].is_overstocked and not found["b"].is_overstocked


def test_reconciliation_levels(spark):
    source = spark.createDataFrame([(1, "a", None), (2, None, "b"), (3, "c", "d")], "id int, x string, y string")
    moved = spark.createDataFrame([(1, None, "a"), (2, None, "b"), (3, "c", "d")], "id int, x string, y string")
    pairs = {
        "same": (source, source.repartition(3).withColumn("_source", F.lit("s"))),
        "moved_null": (source, moved),
        "short": (source, source.filter("id < 3")),
    }
    found = {(r.object_name, r.check_level): r.status for r in reconcile.reconcile_tables(pairs).collect()}
    assert found[("same", "1_counts")] == found[("same", "2_hash")] == "PASS"
    assert found[("moved_null", "1_counts")] == "PASS" and found[("moved_null", "2_hash")] == "FAIL"
    assert found[("short", "1_counts")] == "FAIL"
    a = spark.createDataFrame([(2024, 1.005), (2025, 7.0)], "year int, v double")
    b = spark.createDataFrame([(2024, 1.0), (2026, 1.0)], "year int, v double")
    totals = reconcile.reconcile_totals(a, b, ["year"], {"v": (F.sum(F.col("v").cast("decimal(10,3)")), 0.01)})
    assert [(r.object_name, float(r.difference), r.status) for r in totals.orderBy("object_name").collect()] == [
        ("2024", -0.01, "PASS"), ("2025", -7.0, "FAIL"), ("2026", 1.0, "FAIL"),
    ]


def test_naive_gap_and_pass_rate(spark):
    lines = spark.createDataFrame([(100, True), (3, False)], "net bigint, ok boolean")
    gap = reconcile.naive_gap(lines, F.col("ok"), "net").first()
    assert (gap.overstatement, gap.overstatement_pct) == (3.0, 3.0)
    log = spark.createDataFrame(
        [("r1", "a", "FAIL", at("2025-01-01")), ("r2", "a", "PASS", at("2025-01-02")), ("r2", "a", "FAIL", at("2025-01-03"))],
        "run_id string, check_level string, status string, checked_at timestamp",
    )
    assert rows(reconcile.pass_rate(log)) == [("a", 2, 1, 50.0)]


def test_stories(spark):
    mart = spark.createDataFrame(
        [("a", day("2024-01-01"), 10.0), ("a", day("2025-01-01"), 15.0), ("b", day("2024-01-01"), 4.0)], "k string, month_start date, v double"
    )
    assert rows(stories.yoy_pivot(mart, "k", "v", (2024, 2025))) == [("a", 10.0, 15.0, 50.0), ("b", 4.0, None, None)]
    line = spark.createDataFrame([("x", float(i), 2.0 * i + 1) for i in range(9)], "g string, a double, b double")
    assert rows(stories.group_corr(line, "g", "a", "b")) == [("x", 1.0)]
