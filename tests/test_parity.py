"""Registered queries against their SQL counterparts on the smallest tables."""

from pathlib import Path

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tools.parity import compare, connect, duck_frame, spark_frame

FOLDER = "/root/testdata/sf0.001"
QUICK = (
    "growth_bridge fx_daily inflation_yoy weather_weekly scd2_customers scd2_products scd2_profiles pit_profile asof_price price_contiguity "
    "returns_eur sellout_clean sellout_rejects sellin_sellout promo_performance demand_weekly dq_sales reconcile_counts naive_gap pass_rate "
    "latest_run kpi_sales kpi_rows_top12 pos_events pos_daily lag_features row_filter visibility "
    "access_rule_sql mask_sql manifest_check partition_pruned reconciliation_log build_logged kpi_sales_page"
).split()

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="test tables missing")


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


@pytest.mark.parametrize("name", QUICK)
def test_query_equals_sql(spark, duck, name):
    got = spark_frame(queries()[name](spark, FOLDER))
    assert compare(got, duck_frame(duck, oracle_sql()[name])) is None


def test_every_oracle_has_a_query(spark):
    assert set(oracle_sql()) <= set(queries())
    assert entry(spark).count() > 0
