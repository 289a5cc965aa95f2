"""Registered queries of ingestion, logs, governance and forecast evidence."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.functions.dates import month_of
from shelfline.functions.numbers import count_where
from shelfline.functions.text import masked
from shelfline.operators import dedup, forecast, governance, quality, reconcile, runlog, sales
from shelfline.operators.governance import act_as, install_rules, secured_sql_view
from shelfline.plans import kpi, marts, stories
from shelfline.plans.catalog import _columns, _land_events, demand_of, features_of, lines_of, monthly_of, query, rounded, stored_monthly_of
from shelfline.plans.driver_views import LAST_MONTH, DriverViews
from shelfline.schemas import POS_EVENT, RELATIONAL, SELLOUT_JSON
from shelfline.session import pin, scratch
from shelfline.sources import files, manifest, reference_values, tables
from shelfline.streaming import events as pos
from shelfline.streaming import ingest
from shelfline.streaming.event_table import read_events

# governance -------------------------------------------------------------------------------------------------------------

USERS = ("user7", "user0", "nobody")


def _sold(v: DriverViews) -> DataFrame:
    lines = sales.join_header(v.order_lines, v.orders)
    return lines.join(v.customers.select("customer_id", "country_code"), "customer_id")


@query
def access_rule_sql(v):
    """Two tables behind the SQL access rule, as three users see them."""
    install_rules(v.spark, v.country_access, v.pii_readers)
    sold = pin(_sold(v).select("country_code", "order_date", "net_amount"), "sold")
    sold.createOrReplaceTempView("fact_sales")
    monthly = sold.groupBy(month_of(F.col("order_date")).alias("month_start"), "country_code").agg(F.sum("net_amount").alias("net_amount"))
    pin(monthly, "sold-monthly").createOrReplaceTempView("mart_sales_monthly")
    found = None
    for table in ("fact_sales", "mart_sales_monthly"):
        secured_sql_view(v.spark, f"{table}_secured", table, "country_code")
    for user in USERS:
        act_as(v.spark, user)
        for table in ("fact_sales", "mart_sales_monthly"):
            seen = v.spark.table(f"{table}_secured").groupBy("country_code").agg(F.count(F.lit(1)).alias("rows"), F.sum("net_amount").alias("net_amount"))
            one = pin(seen.select(F.lit(user).alias("user_email"), F.lit(table).alias("table_name"), "*"), "seen")
            found = one if found is None else found.unionByName(one)
    act_as(v.spark)
    return found


@query
def mask_sql(v):
    """Contact data behind the SQL mask, for a reader and for another user."""
    install_rules(v.spark, v.country_access, v.pii_readers)
    columns = ["contact_name", "contact_email", "contact_phone", "vat_number"]
    v.customers.select("customer_id", *columns).createOrReplaceTempView("customers")
    secured_sql_view(v.spark, "customers_masked", "customers", masked_columns=columns)
    found = None
    for user in ("user6", "user7"):
        act_as(v.spark, user)
        one = pin(v.spark.table("customers_masked").withColumn("user_email", F.lit(user)), "masked")
        found = one if found is None else found.unionByName(one)
    act_as(v.spark)
    return found


@query
def table_comments(v):
    """Comments on a table and its columns, next to the rows and values that they describe."""
    name = "orders_described_" + scratch(v.spark, "x")[-12:]
    v.orders.select("order_id", "order_date", "currency").write.option("path", scratch(v.spark, "described")).saveAsTable(name)
    tables.comment_on(v.spark, name, "Order headers, one row per order; it's \'raw\'")
    tables.comment_on(v.spark, name, "Day of the order", "order_date")
    stored = v.spark.table(name)
    values = stored.agg(F.count(F.lit(1)).alias("n"), *[F.count(c).alias(c) for c in stored.columns])
    described = v.spark.sql(f"DESCRIBE TABLE EXTENDED {name}")
    told = described.filter("col_name = \'Comment\' OR col_name IN (\'order_id\', \'order_date\', \'currency\')")
    text = F.when(F.col("col_name") == "Comment", F.col("data_type")).otherwise(F.col("comment"))
    count = F.when(F.col("col_name") == "Comment", F.col("n"))
    for column in stored.columns:
        count = count.when(F.col("col_name") == column, F.col(column))
    # a handful of catalog rows against one row of counts
    rows = told.select(F.when(F.col("col_name") == "Comment", "table").otherwise(F.col("col_name")).alias("object"), text.alias("comment"), "col_name")
    result = pin(rows.join(F.broadcast(values)).select("object", "comment", count.alias("values")), "comments")
    v.spark.sql(f"DROP TABLE {name}")
    return result


# stories ----------------------------------------------------------------------------------------------------------------


@query
def story_checks_all(v):
    """Every expectation about the data, over the bridge, the rankings, the weather and the distributors."""
    monthly = stored_monthly_of(v)
    year = lambda y, c: F.max(F.when(F.col("year") == y, F.col(c)))
    sell_in = sales.join_header(v.order_lines, v.orders).filter(sales.is_reportable())
    by_distributor = sell_in.groupBy("distributor_id", month_of(F.col("order_date")).alias("month_start")).agg(F.sum("qty_cases").alias("cases"))
    spike, usual = F.col("month_start").isin("2000-10-01", "2000-11-01"), F.col("month_start").between("2000-01-01", "2000-09-01")
    frames = {
        "bridge": marts.growth_bridge(monthly, LAST_MONTH),
        "categories": stories.top_members(stories.yoy_pivot(monthly, "category", "net_sales_cfx_eur", (1996, 1997)), "category", 2),
        "countries": stories.top_members(stories.yoy_pivot(monthly, "country_code", "volume_t", (1996, 1997)), "country_code", 2),
        "weather": stories.group_corr(demand_of(v).filter("category = \'PROMO\'"), "country_code", "temp_mean_c", "volume_t"),
        "distributors": stories.spike_ratio(by_distributor, "distributor_id", "cases", spike, usual),
    }
    pricing, volume = year(1998, "pricing_pct"), year(1998, "rig_pct")
    return stories.check_stories(
        frames,
        [
            stories.Story("pricing drives 1998, volume negative", "bridge", F.concat_ws(" / ", pricing.cast("string"), volume.cast("string")), (pricing > 4) & (volume < 0)),
            stories.Story("volume recovers in 1997", "bridge", year(1997, "rig_pct"), year(1997, "rig_pct") > 0),
            stories.Story("ECONOMY and LARGE lead growth", "categories", stories.leaders("category"), stories.leaders("category") == "ECONOMY, LARGE"),
            stories.Story("1 and 2 grow fastest", "countries", stories.leaders("country_code"), stories.leaders("country_code") == "1, 2"),
            stories.Story("sales follow temperature", "weather", F.round(F.avg("corr"), 3), F.avg("corr") > 0.4),
            stories.Story("spike at the largest distributor", "distributors", F.max("spike_ratio"), F.max("spike_ratio") > 2),
        ],
    )


# ingestion --------------------------------------------------------------------------------------------------------------


@query
def manifest_check(v):
    """Orders delivered in files, one of them missing, one short, one unlisted, against their manifest."""
    root = scratch(v.spark, "delivery")
    part = (F.col("order_id") % 8).alias("part")
    orders = v.orders.select("order_id", "order_date", part)
    listed = orders.filter("part <> 6").groupBy("part").count()
    entries = F.map_from_entries(F.collect_list(F.struct(F.concat(F.lit("part="), F.col("part").cast("string")), "count")))
    listed.agg(F.to_json(entries).alias("value")).write.text(f"{root}/manifest")
    short = (F.col("part") == 5) & (F.col("order_id") % 3 == 0)
    orders.filter((F.col("part") != 3) & ~short).write.partitionBy("part").parquet(f"{root}/files")
    folder = F.regexp_extract("_metadata.file_path", "(part=[^/]+)/[^/]+$", 1)
    loaded = manifest.loaded_counts(v.spark.read.parquet(f"{root}/files"), folder)
    found = manifest.manifest_check(manifest.read_manifest(v.spark, f"{root}/manifest"), loaded)
    return found.withColumns({c: F.col(c).cast("bigint") for c in ("source_value", "target_value", "difference")})


@query
def ingest_documents(v):
    """Documents of several lines, one file each, every seventh of them cut off: what is read and what is set aside."""
    root, names = scratch(v.spark, "documents"), _columns("dist s, period_end s, barcode s, sold s, uom s, stock s, market s")
    raw = ["distributor_raw", "week_raw", "ean_raw", "qty_raw", "uom_raw", "stock_raw", "country_raw"]
    rows = v.sellout_raw.filter("layout = \'JSON\'").withColumn("chunk", F.col("_order") % 40)
    record = F.struct(*[F.col(r).alias(n) for r, n in zip(raw, names, strict=True)])
    document = F.to_json(F.struct(F.concat(F.lit("chunk "), F.col("chunk").cast("string")).alias("distributor"), "records"), {"pretty": "true"})
    text = F.when(F.col("chunk") % 7 == 3, F.left(document, F.length(document) - 20)).otherwise(document)
    whole = rows.groupBy("chunk").agg(F.collect_list(record).alias("records")).select("chunk", text.alias("value"))
    whole.repartition("chunk").write.partitionBy("chunk").text(f"{root}/landing")
    stream = ingest.documents_stream(v.spark, f"{root}/landing", SELLOUT_JSON)
    ingest.run_documents(stream, f"{root}/good", f"{root}/broken", f"{root}/checkpoint")
    good = v.spark.read.parquet(f"{root}/good").groupBy("distributor").agg(F.count(F.lit(1)).alias("rows"), F.sum(F.length("barcode")).alias("barcode_chars"))
    broken = v.spark.read.parquet(f"{root}/broken")
    number = F.regexp_extract("_source_file", "chunk=([0-9]+)/", 1)
    aside = broken.select(F.concat(F.lit("chunk "), number).alias("distributor"), F.lit(0).cast("bigint").alias("rows"), F.lit(None).cast("bigint").alias("barcode_chars"))
    return good.withColumn("is_broken", F.lit(False)).unionByName(aside.withColumn("is_broken", F.lit(True)))


@query
def partition_pruned(v):
    """Orders of the first months of a quarter, from a table partitioned by month and a calendar."""
    path = f"{scratch(v.spark, 'partitioned')}/orders"
    months = month_of(F.col("order_date")).alias("order_month")
    tables.write_table(v.orders.select("order_id", "currency", months), path, ["order_month"])
    calendar = pin(marts.dim_date(v.order_span).select(month_of(F.col("date")).alias("month")).distinct(), "calendar")
    wanted = calendar.filter(F.month("month").isin(1, 4, 7, 10))
    found = tables.read_pruned(v.spark, path, "order_month", wanted, "month")
    return found.groupBy("order_month", "currency").agg(F.count(F.lit(1)).alias("orders"))


@query
def ingest_evolving(v):
    """A stream of events into one table; the second delivery brings a field that the first did not have."""
    root, cut = scratch(v.spark, "evolving"), F.lit("2024-01-16").cast("date")
    fields = _columns(POS_EVENT)
    deliveries = (("first", fields, F.col("file_date") < cut, POS_EVENT), ("second", [*fields, "device"], F.col("file_date") >= cut, f"{POS_EVENT}, device string"))
    for name, columns, arrived, schema in deliveries:
        v.pos_events.filter(arrived).select(*columns).write.json(f"{root}/landing/{name}")
        stream = ingest.file_stream(v.spark, f"{root}/landing/{name}", "json", schema)
        ingest.run_evolving(stream, f"{root}/table", f"{root}/checkpoint/{name}")
    table = tables.read_evolving(v.spark, f"{root}/table")
    return table.groupBy("country", "device").agg(F.count(F.lit(1)).alias("events"), F.sum("quantity").alias("quantity"))


@query
def ingest_restart(v):
    """Rows that each run of a file stream adds: a first delivery, nothing new, a second delivery."""
    root, cut = scratch(v.spark, "restart"), F.lit("2024-01-16").cast("date")
    lines = v.pos_events.select(F.to_json(F.struct(*_columns(POS_EVENT))).alias("value"), (F.col("file_date") >= cut).alias("late"))
    added = []
    for run, delivery in enumerate((False, None, True), 1):
        if delivery is not None:
            lines.filter(F.col("late") == F.lit(delivery)).select("value").write.mode("append").text(f"{root}/landing/late={delivery}")
        stream = pos.parse_with_rescue(ingest.file_stream(v.spark, f"{root}/landing", "text", "value string"))
        added.append((run, ingest.run_available_now(stream, f"{root}/table", f"{root}/checkpoint")))
    per_run = v.spark.createDataFrame(added, "run int, rows_added bigint")
    stored = v.spark.read.parquet(f"{root}/table").agg(F.count(F.lit(1)).alias("rows_stored"))
    return per_run.join(F.broadcast(stored))


@query
def reference_csv(v):
    """A reference file written and loaded whole, all columns as text, with its lineage."""
    path = f"{scratch(v.spark, 'reference')}/countries"
    v.countries.write.option("header", "true").csv(path)
    loaded = files.load_csv(v.spark, path)
    known = F.col("_source_file").contains("/countries/") & F.col("_file_modified").isNotNull() & (F.col("_ingested_at") >= F.col("_file_modified"))
    return loaded.select("country_code", "country_name", "currency", known.alias("has_lineage"))


@query
def reference_maps(v):
    """Customers by region of the literal lists, for the nations that a spelling names."""
    aliases, regions = F.broadcast(reference_values.alias_map(v.spark)), F.broadcast(reference_values.region_map(v.spark))
    named = v.table("nation").select("n_nationkey", F.upper(F.trim("n_name")).alias("alias")).join(aliases, "alias").join(regions, "country_code")
    counted = v.table("customer").groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(F.count(F.lit(1)).alias("customers"))
    return named.join(counted, "n_nationkey").select("alias", "country_code", "region", "customers")


# logs -------------------------------------------------------------------------------------------------------------------


def _built(v: DriverViews) -> tuple[str, str]:
    """A small store built table by table, each step logged, one of them failing; returns (root, log)."""
    root = scratch(v.spark, "store")
    log = f"{root}/ops/run_log"
    sources = {"orders": lambda: v.orders, "customers": lambda: v.customers, "suppliers": lambda: v.spark.read.schema(RELATIONAL["countries"]).parquet(f"{root}/absent")}
    tables.snapshot_all(v.spark, sources, root, "source", "run-1", log)
    orders = v.spark.read.parquet(tables.table_path(root, "bronze", "orders"))
    lines = tables.build(v.spark, root, "silver", "sales_order_lines", sales.join_header(v.order_lines, reconcile.drop_technical(orders)), "run-1", "silver_sales", log)
    tables.build(v.spark, root, "gold", "fact_sales", sales.reportable(lines), "run-1", "gold", log)
    return root, log


@query
def build_logged(v):
    """The run log of a build: a snapshot with a failing table, a silver and a gold step."""
    _, log = _built(v)
    rows = v.spark.read.parquet(log)
    timed = (F.col("ended_at") >= F.col("started_at")) & (F.col("duration_s") >= 0)
    return rows.select("run_id", "layer", "step", "target_table", "rows_written", "status", F.col("message").isNotNull().alias("has_message"), timed.alias("timed"))


@query
def stored_table_counts(v):
    """Rows of every stored table, counted where they are stored."""
    root, _ = _built(v)
    counted = tables.stored_counts(v.spark, root)
    return counted.select("layer", "table_name", "row_count", F.col("counted_at").isNotNull().alias("is_timed"))


def _reconciled(v: DriverViews, run: int) -> DataFrame:
    """Counts, totals and checksums of a run; the first run lost rows."""
    lines = v.order_lines.select("order_id", "line_no", "qty_cases", "net_amount")
    loaded = lines.filter("order_id % 1000 <> 0") if run == 0 else lines
    counts = reconcile.reconcile_tables({"order_lines": (lines, loaded)})
    totals = reconcile.reconcile_totals(lines.withColumn("object", F.lit("all")), loaded.withColumn("object", F.lit("all")), ["object"], {"net_amount": (F.sum("net_amount"), 0.01), "cases": (F.sum("qty_cases"), 0.0)})
    columns = ["check_level", "object_name", "check_name", "status"]
    kept = counts.select(*columns, *[F.col(c).cast("decimal(38,2)").alias(c) for c in ("source_value", "target_value", "difference")])
    return kept.filter("check_level = \'1_counts\'").unionByName(totals.select(*kept.columns))


def _logged_results(v: DriverViews) -> str:
    """Reconciliation rows and quality checks of three runs, appended to one log each; returns the folder."""
    root, started = scratch(v.spark, "results"), runlog.utc_now()
    for run in range(2):
        at = started + runlog.dt.timedelta(minutes=run)
        tables.append_table(runlog.stamped(_reconciled(v, run), f"run-{run}", at), f"{root}/reconciliation")
    checks = quality.orphan_check(v.order_lines, v.orders)
    tables.append_table(runlog.stamped(checks, "run-2", started + runlog.dt.timedelta(minutes=2)), f"{root}/quality")
    return root


@query
def reconciliation_log(v):
    """The reconciliation rows that two runs appended, without their times."""
    rows = v.spark.read.parquet(f"{_logged_results(v)}/reconciliation")
    return rows.select("run_id", "check_level", "object_name", "check_name", "source_value", "target_value", "difference", "status", F.col("checked_at").isNotNull().alias("is_timed"))


@query
def recon_figures(v):
    """Figures of the newest reconciliation run and of the newest quality run, each by its own log."""
    root = _logged_results(v)
    recon, checks = (v.spark.read.parquet(f"{root}/{name}") for name in ("reconciliation", "quality"))
    return rounded(runlog.result_kpis({"reconciliation": recon, "quality": checks.withColumn("difference", F.lit(0.0))}))


@query
def audit_columns(v):
    """Order lines and orders with the time and label of their load."""
    lines = tables.with_provenance(lines_of(v, sales.CUSTOMER, sales.COST), "silver/sales_order_lines")
    orders = tables.with_provenance(v.orders, "bronze/orders")
    found = None
    for df in (lines, orders):
        known = count_where(F.col("_ingested_at").isNotNull() & (F.col("_ingested_at") <= F.current_timestamp()))
        one = df.groupBy(F.col("_source").alias("source")).agg(F.count(F.lit(1)).alias("rows"), known.alias("timed_rows"), F.countDistinct("_ingested_at").alias("loads"))
        found = one if found is None else found.unionByName(one)
    return found


# forecast ---------------------------------------------------------------------------------------------------------------

_MODELS: dict[tuple[str, str], str] = {}


def _modelled(v: DriverViews) -> str:
    """Folder with the features, the saved model and its forecast; the model is trained once per application."""
    key = (v.spark.sparkContext.applicationId, v.folder)
    if key not in _MODELS:
        root = scratch(v.spark, "forecast")
        features_of(v).write.parquet(f"{root}/features")
        data = v.spark.read.parquet(f"{root}/features")
        model = forecast.train(data)
        draft = pin(forecast.forecast_weekly(model, data, "draft"))
        params = {"rounds_at_most": forecast.ROUNDS, "step": forecast.STEP, "depth": forecast.DEPTH}
        version = forecast.save_model(model, f"{root}/registry", forecast.forecast_accuracy(draft), params)
        forecast.forecast_weekly(forecast.load_model(f"{root}/registry", version), data, str(version)).write.parquet(f"{root}/forecast")
        _MODELS[key] = root
    return _MODELS[key]


@query
def gbt_forecast(v):
    """Test and future weeks as the saved model scores them.  The forecast itself has no counterpart elsewhere; whether
    there is a finite one for every row does."""
    rows = v.spark.read.parquet(f"{_modelled(v)}/forecast")
    known = F.col("forecast_t").isNotNull() & ~F.isnan("forecast_t") & (F.abs("forecast_t") < float("inf"))
    return rows.select("week_start", "country_code", "category", "actual_t", "baseline_t", "is_future", "model_version", known.alias("has_forecast"))


@query
def gbt_accuracy(v):
    """Errors of the seasonal naive baseline, and whether the model's are lower over all test weeks."""
    rows = v.spark.read.parquet(f"{_modelled(v)}/forecast")
    model = forecast.forecast_accuracy(rows).select("level", "member", F.col("wape_pct").alias("model_wape_pct"))
    naive = forecast.forecast_accuracy(rows.withColumn("forecast_t", F.col("baseline_t")))
    better = F.when(F.col("level") == "total", F.col("model_wape_pct") < F.col("wape_pct"))
    known = F.col("model_wape_pct").isNotNull()
    return naive.join(model, ["level", "member"]).select("level", "member", "wape_pct", "mape_pct", "bias_pct", known.alias("has_model_wape"), better.alias("model_is_better"))


@query
def model_versions(v):
    """Versions of the stored model: parameters, and whether a stored model forecasts as it did before."""
    root = _modelled(v)
    data, made = v.spark.read.parquet(f"{root}/features"), v.spark.read.parquet(f"{root}/forecast")
    registry = scratch(v.spark, "registry")
    model = forecast.load_model(f"{root}/registry", 1)
    accuracy = forecast.forecast_accuracy(made)
    for step in (1, 2):
        forecast.save_model(model, registry, accuracy, {"saved": step})
    found = None
    keys = ["week_start", "country_code", "category"]
    for version in (1, 2):
        again = forecast.forecast_weekly(forecast.load_model(registry, version), data, str(version))
        both = again.join(made.select(*keys, F.col("forecast_t").alias("before")), keys)
        one = both.agg(F.lit(version).alias("version"), F.count(F.lit(1)).alias("rows"), count_where(F.col("forecast_t") == F.col("before")).alias("same"))
        found = one if found is None else found.unionByName(one)
    logged = v.spark.read.parquet(f"{registry}/metrics").groupBy("version").agg(F.first("params").alias("params"), F.count(F.lit(1)).alias("metric_rows"))
    return found.join(logged, "version")


@query
def rolling_forecast(v):
    return rounded(forecast.rolling_mean(features_of(v)))


@query
def rolling_forecast_metrics(v):
    """Accuracy of a forecast that differs from the baseline."""
    return forecast.forecast_accuracy(forecast.rolling_mean(features_of(v)))


@query
def kpi_rolling_forecast(v):
    return rounded(kpi.forecast_kpis(forecast.rolling_mean(features_of(v)), ["category"]))
