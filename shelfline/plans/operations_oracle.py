"""SQL counterparts of the queries of ingestion, logs, governance and forecast evidence."""

from __future__ import annotations

from shelfline.plans.oracle import ERRORS, MASKS, cte, oracle
from shelfline.sources.reference_values import COUNTRY_SPELLINGS, REGION_OF_COUNTRY

# governance -------------------------------------------------------------------------------------------------------------

cte("sold_months", "SELECT date_trunc('month', order_date)::date AS month_start, country_code, sum(net_amount) AS net_amount FROM sold_days GROUP BY ALL")
cte("sold_days", "SELECT country_code, order_date, net_amount FROM sold JOIN heads USING (order_id)")


def seen_by(user: str, table: str, source: str) -> str:
    return f"""SELECT '{user}' AS user_email, '{table}' AS table_name, country_code, count(*) AS rows, sum(net_amount)::double AS net_amount FROM {source} s
WHERE EXISTS (SELECT 1 FROM access a WHERE a.user_email = '{user}' AND a.country_code IN ('ALL', s.country_code)) GROUP BY ALL"""


oracle(
    "access_rule_sql",
    " UNION ALL ".join(seen_by(u, t, s) for u in ("user7", "user0", "nobody") for t, s in (("fact_sales", "sold_days"), ("mart_sales_monthly", "sold_months"))),
)
oracle(
    "mask_sql",
    " UNION ALL ".join(
        f"SELECT customer_id, '{user}' AS user_email, {MASKS.replace('c_custkey % 30 = 7', f'c_custkey % 30 = {user[4:]}')} FROM cust" for user in ("user6", "user7")
    ),
)
oracle(
    "table_comments",
    """
SELECT 'table' AS object, 'Order headers, one row per order; it''s ''raw''' AS comment, count(*) AS "values" FROM heads
UNION ALL SELECT 'order_id', NULL, count(order_id) FROM heads UNION ALL SELECT 'order_date', 'Day of the order', count(order_date) FROM heads
UNION ALL SELECT 'currency', NULL, count(currency) FROM heads""",
)

# stories ----------------------------------------------------------------------------------------------------------------


def two_leaders(key: str, measure: str) -> str:
    return f"""(SELECT string_agg({key}, ', ' ORDER BY {key}) FROM (
        SELECT {key} FROM (SELECT {key}, (sum({measure}::decimal(24,3)) FILTER (year(month_start) = 1996))::double AS a,
                                  (sum({measure}::decimal(24,3)) FILTER (year(month_start) = 1997))::double AS b FROM monthly GROUP BY ALL)
        ORDER BY round(100 * (b / nullif(a, 0) - 1), 1) DESC NULLS LAST, {key} LIMIT 2))"""


def verdict_of(story: str, found: str, holds: str) -> str:
    return f"SELECT '{story}' AS story, {found}::varchar AS found, CASE WHEN {holds} THEN 'PASS' ELSE 'FAIL' END AS status"


YEAR_OF = "(SELECT {} FROM bridge WHERE year = {})"
PRICING, VOLUME, RECOVERY = (YEAR_OF.format(c, y) for c, y in (("pricing_pct", 1998), ("rig_pct", 1998), ("rig_pct", 1997)))
CORRELATION = "(SELECT avg(c) FROM (SELECT round(corr(volume_t, temp_mean_c), 4) AS c FROM demand WHERE category = 'PROMO' GROUP BY country_code))"
SPIKE = """(SELECT round(avg(v) FILTER (m IN (DATE '2000-10-01', DATE '2000-11-01')) / avg(v) FILTER (m BETWEEN DATE '2000-01-01' AND DATE '2000-09-01'), 2)
FROM (SELECT distributor_id, date_trunc('month', order_date)::date AS m, sum(qty_cases)::double AS v
      FROM lines l JOIN heads o ON o.order_id = l.order_id WHERE NOT is_deleted AND order_status <> 'Cancelled' GROUP BY ALL)
GROUP BY distributor_id ORDER BY sum(v) DESC, distributor_id DESC LIMIT 1)"""
CATEGORIES, COUNTRIES = two_leaders("category", "net_sales_cfx_eur"), two_leaders("country_code", "volume_t")
oracle(
    "story_checks_all",
    " UNION ALL ".join(
        (
            verdict_of("pricing drives 1998, volume negative", f"concat_ws(' / ', {PRICING}, {VOLUME})", f"{PRICING} > 4 AND {VOLUME} < 0"),
            verdict_of("volume recovers in 1997", RECOVERY, f"{RECOVERY} > 0"),
            verdict_of("ECONOMY and LARGE lead growth", CATEGORIES, f"{CATEGORIES} = 'ECONOMY, LARGE'"),
            verdict_of("1 and 2 grow fastest", COUNTRIES, f"{COUNTRIES} = '1, 2'"),
            verdict_of("sales follow temperature", f"round({CORRELATION}, 3)", f"{CORRELATION} > 0.4"),
            verdict_of("spike at the largest distributor", SPIKE, f"{SPIKE} > 2"),
        )
    ),
)

# ingestion --------------------------------------------------------------------------------------------------------------

oracle(
    "manifest_check",
    """
SELECT '0_manifest' AS check_level, 'part=' || part AS object_name, 'row_count' AS check_name, s AS source_value, t AS target_value, t - s AS difference, problem,
       CASE WHEN problem IS NULL THEN 'PASS' ELSE 'FAIL' END AS status
FROM (SELECT *, CASE WHEN part = 3 THEN 'missing' WHEN part = 6 THEN 'unlisted' WHEN t < s THEN 'short' END AS problem
      FROM (SELECT order_id % 8 AS part, CASE WHEN order_id % 8 = 6 THEN 0 ELSE count(*) END AS s,
                   count(*) FILTER (order_id % 8 <> 3 AND NOT (order_id % 8 = 5 AND order_id % 3 = 0)) AS t FROM heads GROUP BY order_id % 8))""",
)
cte("so_chunks", "SELECT l_orderkey % 40 AS chunk, CASE WHEN dirt = 2 THEN '7.60901E+12' WHEN dirt = 4 THEN '4000000123456' WHEN dirt = 7 THEN '0000 000000000' ELSE code END AS barcode FROM so_sent WHERE layout = 'JSON'")
oracle(
    "ingest_documents",
    """
SELECT 'chunk ' || chunk AS distributor, CASE WHEN chunk % 7 = 3 THEN 0 ELSE count(*) END AS rows,
       CASE WHEN chunk % 7 <> 3 THEN sum(length(barcode))::bigint END AS barcode_chars, chunk % 7 = 3 AS is_broken FROM so_chunks GROUP BY chunk""",
)
oracle(
    "partition_pruned",
    "SELECT date_trunc('month', order_date)::date AS order_month, currency, count(*) AS orders FROM heads WHERE month(order_date) IN (1, 4, 7, 10) GROUP BY ALL",
)
oracle(
    "ingest_evolving",
    """
SELECT country, CASE WHEN file_date >= DATE '2024-01-16' THEN device END AS device, sum(n)::bigint AS events, sum(n * quantity)::bigint AS quantity
FROM (SELECT *, CASE WHEN is_copied THEN 2 ELSE 1 END AS n FROM pos_once) GROUP BY ALL""",
)
cte("pos_sent", "SELECT (sum(n) FILTER (file_date < DATE '2024-01-16'))::bigint AS first, sum(n)::bigint AS n FROM (SELECT file_date, CASE WHEN is_copied THEN 2 ELSE 1 END AS n FROM pos_once)")
oracle("ingest_restart", "SELECT unnest([1, 2, 3])::int AS run, unnest([first, 0, n - first]) AS rows_added, n AS rows_stored FROM pos_sent")
oracle("reference_csv", "SELECT country_code, country_name, currency, true AS has_lineage FROM nations")


def literal(rows: list[tuple], columns: str) -> str:
    return f"(VALUES {', '.join(str(r) for r in rows)}) t({columns})"


oracle(
    "reference_maps",
    f"""
SELECT alias, country_code, region, count(*) AS customers
FROM (SELECT n_nationkey, upper(trim(n_name)) AS alias FROM nation) JOIN (SELECT * FROM {literal([(n.upper(), c) for c, names in COUNTRY_SPELLINGS.items() for n in names], 'alias, country_code')}) USING (alias)
     JOIN (SELECT * FROM {literal(list(REGION_OF_COUNTRY.items()), 'country_code, region')}) USING (country_code) JOIN customer ON c_nationkey = n_nationkey
GROUP BY ALL""",
)

# logs -------------------------------------------------------------------------------------------------------------------

cte("joined_count", "SELECT count(*) AS n, count(*) FILTER (NOT is_deleted AND order_status <> 'Cancelled') AS kept FROM lines l JOIN heads o ON o.order_id = l.order_id")
LOGGED = "SELECT 'run-1' AS run_id, '{}' AS layer, '{}' AS step, '{}' AS target_table, {} AS rows_written, '{}' AS status, {} AS has_message, true AS timed{}"
oracle(
    "build_logged",
    " UNION ALL ".join(
        LOGGED.format(*r)
        for r in (
            ("bronze", "snapshot", "bronze.orders", "count(*)", "SUCCESS", "false", " FROM heads"),
            ("bronze", "snapshot", "bronze.customers", "count(*)", "SUCCESS", "false", " FROM cust"),
            ("bronze", "snapshot", "bronze.suppliers", "0", "FAILED", "true", ""),
            ("silver", "silver_sales", "silver.sales_order_lines", "n", "SUCCESS", "false", " FROM joined_count"),
            ("gold", "gold", "gold.fact_sales", "kept", "SUCCESS", "false", " FROM joined_count"),
        )
    ),
)
oracle(
    "stored_table_counts",
    """
SELECT 'bronze' AS layer, 'orders' AS table_name, count(*) AS row_count, true AS is_timed FROM heads UNION ALL SELECT 'bronze', 'customers', count(*), true FROM cust
UNION ALL SELECT 'silver', 'sales_order_lines', n, true FROM joined_count UNION ALL SELECT 'gold', 'fact_sales', kept, true FROM joined_count""",
)
cte(
    "recon_rows",
    """
SELECT 'run-' || run AS run_id, level AS check_level, object AS object_name, name AS check_name, s::double AS source_value, t::double AS target_value, (t - s)::double AS difference,
       CASE WHEN t = s THEN 'PASS' ELSE 'FAIL' END AS status
FROM (SELECT run, unnest(['1_counts', '3_business', '3_business']) AS level, unnest(['order_lines', 'all', 'all']) AS object, unnest(['row_count', 'net_amount', 'cases']) AS name,
             unnest([n::decimal(38,2), net::decimal(38,2), cases::decimal(38,2)]) AS s,
             unnest([CASE WHEN run = 0 THEN n0 ELSE n END::decimal(38,2), CASE WHEN run = 0 THEN net0 ELSE net END::decimal(38,2), CASE WHEN run = 0 THEN cases0 ELSE cases END::decimal(38,2)]) AS t
      FROM (SELECT count(*) AS n, sum(net_amount) AS net, sum(qty_cases) AS cases, count(*) FILTER (order_id % 1000 <> 0) AS n0,
                   sum(net_amount) FILTER (order_id % 1000 <> 0) AS net0, sum(qty_cases) FILTER (order_id % 1000 <> 0) AS cases0 FROM lines) CROSS JOIN range(2) r(run))""",
)
oracle("reconciliation_log", "SELECT *, true AS is_timed FROM recon_rows")
oracle(
    "recon_figures",
    """
SELECT 'reconciliation' AS kind, 'run-1' AS run_id, count(*) AS checks, count(*) FILTER (status = 'PASS') AS passed, round(count(*) FILTER (status = 'PASS')::double / count(*), 6) AS pass_rate,
       sum(abs(difference)) AS difference_total FROM recon_rows WHERE run_id = 'run-1'
UNION ALL SELECT 'quality', 'run-2', 1, p, p::double, 0 FROM (SELECT CASE WHEN count(*) = 0 THEN 1 ELSE 0 END AS p FROM lines WHERE order_id NOT IN (SELECT order_id FROM heads))""",
)
oracle(
    "audit_columns",
    """
SELECT 'silver/sales_order_lines' AS source, n AS rows, n AS timed_rows, 1 AS loads FROM joined_count
UNION ALL SELECT 'bronze/orders', count(*), count(*), 1 FROM heads""",
)

# forecast ---------------------------------------------------------------------------------------------------------------

oracle(
    "gbt_forecast",
    "SELECT week_start, country_code, category, actual_t, baseline_t, is_future, '1' AS model_version, true AS has_forecast FROM naive",
)
ACCURACY = f"""
SELECT 'category' AS level, category AS member, {ERRORS} FROM {{source}} WHERE NOT is_future GROUP BY ALL
UNION ALL SELECT 'country_code', country_code, {ERRORS} FROM {{source}} WHERE NOT is_future GROUP BY ALL
UNION ALL SELECT 'total', 'all', {ERRORS} FROM {{source}} WHERE NOT is_future"""
oracle("gbt_accuracy", f"SELECT *, true AS has_model_wape, CASE WHEN level = 'total' THEN true END AS model_is_better FROM ({ACCURACY.format(source='naive')})")
oracle(
    "model_versions",
    """
SELECT version::int AS version, n AS rows, n AS same, 'saved=' || version AS params, m AS metric_rows
FROM (SELECT count(*) AS n FROM naive) CROSS JOIN range(1, 3) t(version)
CROSS JOIN (SELECT count(DISTINCT category) + count(DISTINCT country_code) + 1 AS m FROM naive WHERE NOT is_future)""",
)
cte(
    "rolling",
    """
SELECT week_start, country_code, category, volume_t AS actual_t, round(roll4_lag12::decimal(24,6), 3)::double AS forecast_t, lag_52 AS baseline_t, role = 'future' AS is_future
FROM feature_rows WHERE role <> 'train'""",
)
oracle("rolling_forecast", "SELECT * FROM rolling")
oracle("rolling_forecast_metrics", ACCURACY.format(source="rolling"))


def off(column: str, name: str) -> str:
    value, actual = (f"{c}::decimal(24,3)" for c in (column, "actual_t"))
    return f"""(sum(abs({actual} - {value})) FILTER (NOT is_future))::double AS {name}_err, (sum({value} - {actual}) FILTER (NOT is_future))::double AS {name}_bias,
             avg(abs(actual_t - {column}) / actual_t) FILTER (NOT is_future AND actual_t > 0) AS {name}_ape"""


oracle(
    "kpi_rolling_forecast",
    f"""
SELECT category, actual_t, forecast_t, seasonal_naive_t, round(1 - f_err / actual_t, 6) AS forecast_accuracy, round(1 - b_err / actual_t, 6) AS baseline_accuracy,
       round(f_ape, 6) AS mape, round(b_ape, 6) AS baseline_mape, round(f_bias / actual_t, 6) AS bias, round(b_bias / actual_t, 6) AS baseline_bias, abs(f_bias / actual_t) <= 0.05 AS bias_within_5pct
FROM (SELECT category, (sum(actual_t::decimal(24,3)) FILTER (NOT is_future))::double AS actual_t, sum(forecast_t::decimal(24,3))::double AS forecast_t,
             sum(baseline_t::decimal(24,3))::double AS seasonal_naive_t, {off('forecast_t', 'f')}, {off('baseline_t', 'b')} FROM rolling GROUP BY ALL)""",
)
