"""Fixed schemas of inputs and operational tables."""

from __future__ import annotations

# Relational source tables.
RELATIONAL = {
    "countries": "country_code string, country_name string, currency string, capital string",
    "products": "sku int, product_name string, brand string, category string, subcategory string, pack_size string, "
    "units_per_case int, case_weight_kg decimal(9,2), ean string, launch_date date, discontinued_date date, status string",
    "customers": "customer_id string, customer_name string, country_code string, channel string, customer_type string, "
    "key_account_manager string, credit_limit_eur int, contact_name string, contact_email string, contact_phone string, "
    "vat_number string, created_at timestamp, is_distributor boolean",
    "price_list": "sku int, country_code string, currency string, list_price_case decimal(12,2), valid_from date, valid_to date",
    "standard_cost": "sku int, fiscal_quarter string, std_cost_eur_case decimal(12,2)",
    "customer_changes": "change_id int, customer_id string, field_name string, old_value string, new_value string, changed_at timestamp",
    "product_changes": "change_id int, sku int, field_name string, old_value string, new_value string, changed_at timestamp",
    "promotions": "promo_id string, customer_id string, category string, duration_weeks int, discount_pct decimal(5,4), "
    "mechanic string, start_date date, end_date date, planned_uplift_pct decimal(6,1)",
    "sales_orders": "order_id bigint, customer_id string, order_date date, requested_delivery_date date, currency string, "
    "order_status string, sales_channel string, is_deleted boolean, created_at timestamp",
    "sales_order_lines": "order_id bigint, line_no int, sku int, qty_cases int, list_price_case decimal(12,2), "
    "discount_pct decimal(6,4), net_amount decimal(14,2), promo_id string",
    "returns": "return_id int, order_id bigint, line_no int, return_date date, qty_cases int, reason_code string, "
    "credit_amount decimal(14,2)",
}

# Sell-out files, every leaf as text.
SELLOUT_A = (
    "Distributor string, Week_Ending string, EAN string, Product_Desc string, Qty_Sold string, UoM string, "
    "Closing_Stock string, Country string"
)
SELLOUT_B = (
    "distributor_id string, week_end_date string, gtin string, description string, units_sold string, unit string, "
    "stock_on_hand string, country string"
)
SELLOUT_JSON = (
    "distributor string, generated_at string, records array<struct<dist: string, period_end: string, barcode: string, "
    "sold: string, uom: string, stock: string, market: string>>"
)

# Event fields known to the engine; any other field is rescued.
POS_EVENT = (
    "event_id string, event_type string, event_ts string, retailer_id string, country string, ean string, quantity int, "
    "unit_price double, currency string"
)

# Public series, read as text.
PUBLIC = {
    "fx_rates_daily": "rate_date string, currency string, rate_per_eur string, source string",
    "food_inflation_monthly": "country_code string, month string, index_value string, base string, source string",
    "weather_daily": "country_code string, city string, weather_date string, temperature_2m_mean string, "
    "temperature_2m_max string, precipitation_sum string, source string",
}

# Operational tables.
RUN_LOG = (
    "run_id string, layer string, step string, target_table string, rows_written bigint, started_at timestamp, "
    "ended_at timestamp, duration_s double, status string, message string"
)
DQ_RESULTS = (
    "run_id string, layer string, table_name string, check_name string, failed_rows bigint, total_rows bigint, "
    "failed_pct double, threshold_pct double, status string, checked_at timestamp"
)
RECONCILIATION = (
    "run_id string, check_level string, object_name string, check_name string, source_value decimal(38,2), "
    "target_value decimal(38,2), difference decimal(38,2), status string, checked_at timestamp"
)
USER_COUNTRY_ACCESS = "user_email string, country_code string"
PII_READERS = "user_email string"
