import datetime as dt
import math

import pytest
from conftest import at, day, rows
from pyspark.sql import functions as F

from shelfline.functions.numbers import duration_text
from shelfline.operators import dedup, forecast, governance, runlog
from shelfline.schemas import RUN_LOG
from shelfline.sources import files, tables


def test_write_append_evolve_and_cluster(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(10).withColumn("d", F.date_add(F.lit("2025-01-01").cast("date"), (F.col("id") * 7 % 10).cast("int")))
    assert tables.write_table(df, path) == 10
    assert tables.append_table(df.limit(3).withColumn("extra", F.lit("x")), path) == 3
    assert sorted(tables.read_evolving(spark, path).columns) == ["d", "extra", "id"]
    assert tables.write_table(df.drop("d"), path) == 10 and spark.read.parquet(path).columns == ["id"]
    clustered = str(tmp_path / "c")
    assert tables.write_clustered(df, clustered, "d", 4) == 10
    spans = spark.read.parquet(clustered).groupBy(F.input_file_name()).agg(F.min("d").alias("a"), F.max("d").alias("b")).orderBy("a").collect()
    assert all(x.b < y.a for x, y in zip(spans, spans[1:], strict=False))
    assert tables.read_partitioned(spark, clustered).count() == 10


def test_insert_new_is_idempotent(spark, tmp_path):
    path = str(tmp_path / "t")
    first = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b")], "id int, v string")
    assert tables.insert_new(spark, path, first, ["id"]) == 2
    assert tables.insert_new(spark, path, first.unionByName(spark.createDataFrame([(3, "c")], "id int, v string")), ["id"]) == 1
    assert rows(spark.read.parquet(path), "id") == [(1,), (2,), (3,)]


def test_snapshot_goes_on_after_a_failure(spark, tmp_path):
    root, log = str(tmp_path), str(tmp_path / "ops" / "run_log")

    def broken():
        raise ValueError("x" * 900)

    readers = {"bad": broken, "good": lambda: spark.range(4)}
    tables.snapshot_all(spark, readers, root, "source", "run-1", log)
    found = {r.target_table: r for r in spark.read.parquet(log).collect()}
    assert found["bronze.bad"].status == "FAILED" and len(found["bronze.bad"].message) == 500
    assert (found["bronze.good"].status, found["bronze.good"].rows_written) == ("SUCCESS", 4)
    assert {"_ingested_at", "_source"} <= set(spark.read.parquet(f"{root}/bronze/good").columns)
    mart = tables.build(spark, root, "gold", "mart", spark.range(7), "run-1", "marts", log)
    assert mart.count() == 7
    assert rows(runlog.latest_status(spark.read.parquet(log)), "target_table", "rows_written")[-1] == ("gold.mart", 7)


def test_comments(spark):
    spark.sql("CREATE TABLE IF NOT EXISTS commented (id INT, v STRING) USING parquet")
    tables.comment_on(spark, "commented", "it's a table")
    tables.comment_on(spark, "commented", "a column", "v")
    assert spark.catalog.getTable("commented").description == "it's a table"
    described = {r.col_name: r.comment for r in spark.sql("DESCRIBE commented").collect()}
    assert described["v"] == "a column"
    spark.sql("DROP TABLE commented")


def test_csv_reader_keeps_text(spark, tmp_path):
    (tmp_path / "f.csv").write_text("rate_date,currency,rate_per_eur\n2025-01-01,PLN,4.10\n")
    df = files.load_csv(spark, str(tmp_path / "f.csv"))
    assert df.select("rate_per_eur").first()[0] == "4.10" and df.select("_source_file").first()[0].endswith("f.csv")


def test_newest_and_distinct(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", 1, None)], "k string, t int, v string")
    assert rows(dedup.newest_per_key(df, ["k"], ["t"])) == [("a", 2, "y"), ("b", 1, None)]
    twice = df.unionByName(df)
    assert rows(dedup.dedup_exact(twice, ["k"]), "k", "t") == [("a", 1), ("b", 1)]
    assert twice.agg(dedup.distinct_count(["k", "v"]).alias("n")).first().n == 3


def log_of(spark):
    t = at("2025-01-01")
    minutes = lambda m: t + dt.timedelta(minutes=m)
    data = [("r1", "bronze", 0), ("r1", "gold", 5), ("r2", "bronze", 100), ("r2", "bronze", 110), ("r2", "gold", 130)]
    made = [(r, layer, "snapshot" if layer == "bronze" else "marts", f"{layer}.t", 1, minutes(m), minutes(m + 2), 120.0, "SUCCESS", None) for r, layer, m in data]
    return spark.createDataFrame(made, RUN_LOG)


def test_latest_batch_and_platform_figures(spark):
    log = log_of(spark)
    flagged = runlog.flag_latest(log, log)
    assert [r.is_latest_run for r in flagged.orderBy("started_at").collect()] == [False, False, True, True, True]
    checks = log.select(F.col("started_at").alias("checked_at"), F.when(F.col("layer") == "gold", "FAIL").otherwise("PASS").alias("status"), F.lit(-2.0).alias("difference"))
    counts = spark.createDataFrame([("bronze", "a", 2_000_000), ("silver", "b", 500_000), ("gold", "c", 5)], "layer string, table_name string, row_count bigint")
    figures = runlog.platform_kpis(log, checks, counts, "snapshot").first()
    assert (figures.pipeline_runs, figures.rows_processed_m, figures.silver_rows_m, figures.tables, figures.gold_tables) == (2, 2.0, 0.5, 3, 1)
    assert (figures.checks_total, figures.checks_failed, figures.checks_passed, figures.difference_total) == (3, 1, "2 / 3", 6.0)
    assert figures.last_run_duration == "32 min 00 s"
    assert spark.range(1).select(duration_text(F.lit(547))).first()[0] == "9 min 07 s"


def test_row_filter_mask_and_grants(spark):
    access = spark.createDataFrame([("boss", "ALL"), ("pl", "PL"), ("two", "PL"), ("two", "DE")], "user_email string, country_code string")
    sales = spark.createDataFrame([("PL", 1e6), ("DE", 2e6), (None, 4e6)], "country_code string, net double")
    seen = {u: [r[0] for r in rows(governance.row_filter(sales, access, u), "country_code")] for u in ("boss", "pl", "two", "nobody")}
    assert seen == {"boss": ["DE", "PL", None], "pl": ["PL"], "two": ["DE", "PL"], "nobody": []}
    only = governance.grant(governance.grant(access, "boss", "PL"), "new", "DE")
    assert [r[0] for r in rows(governance.row_filter(sales, only, "boss"), "country_code")] == ["PL"]
    assert [r[0] for r in rows(governance.row_filter(sales, only, "new"), "country_code")] == ["DE"]
    assert rows(governance.visibility(governance.row_filter(sales, only, "boss"), "net")) == [(1, 1.0, "PL")]
    readers = spark.createDataFrame([("boss",)], "user_email string")
    people = spark.createDataFrame([("Ann", None)], "name string, phone string")
    assert rows(governance.mask_columns(people, ["name", "phone"], readers, "boss")) == [("Ann", None)]
    assert rows(governance.mask_columns(people, ["name", "phone"], readers, "pl")) == [("A***", None)]
    governance.register_functions(spark)
    assert spark.sql("SELECT mask_text('Ann', false), mask_text('Ann', true), may_see('PL', 'ALL'), may_see('PL', 'DE')").first() == ("A***", "Ann", True, False)
    governance.secured_view(spark, "seen_sales", sales, access, "pl")
    assert spark.table("seen_sales").count() == 1


@pytest.fixture(scope="module")
def demand(spark):
    start = day("2023-01-02")
    data = []
    for country in ("DE", "PL"):
        for category in ("Coffee", "Water"):
            for w in range(110):
                if (country, category, w) == ("PL", "Water", 30):
                    continue  # a missing week shifts row lags
                level = 100 + 10 * math.sin(2 * math.pi * w / 52) + (5 if country == "DE" else 0)
                data.append((start + dt.timedelta(weeks=w), country, category, round(level, 3), 0.1, float(w % 20)))
    data.append((start, "SE", "Coffee", 1.0, 0.0, 1.0))  # shorter than a year: no rows
    return spark.createDataFrame(data, "week_start date, country_code string, category string, volume_t double, promo_line_share double, temp_mean_c double")


def test_forecast_features(spark, demand):
    frame = forecast.forecast_frame(demand, forecast.last_full_week(demand))
    last = day("2023-01-02") + dt.timedelta(weeks=108)
    assert frame.filter("volume_t IS NULL").groupBy("country_code", "category").count().filter("count <> 12").count() == 0
    data = forecast.features(frame)
    assert {r.role: r.n for r in data.groupBy("role").agg(F.count("*").alias("n")).collect()}["test"] == 48
    assert data.filter("country_code = 'SE'").count() == 0
    row = data.filter((F.col("week_start") == last) & (F.col("country_code") == "DE") & (F.col("category") == "Coffee")).first()
    by_week = {r.week_start: r.volume_t for r in demand.filter("country_code = 'DE' AND category = 'Coffee'").collect()}
    back = lambda k: by_week[last - dt.timedelta(weeks=k)]
    assert (row.lag_12, row.lag_52) == (back(12), back(52))
    assert abs(row.roll4_lag12 - sum(back(k) for k in (12, 13, 14, 15)) / 4) < 1e-9
    assert (row.country_id, row.category_id) == (0, 0)
    gap = data.filter((F.col("week_start") == last) & (F.col("country_code") == "PL") & (F.col("category") == "Water")).first()
    assert gap.lag_52 is not None


def test_model_scores_saves_and_beats_nothing_silly(spark, demand, tmp_path):
    data = forecast.features(forecast.forecast_frame(demand, forecast.last_full_week(demand))).cache()
    model = forecast.train(data, iterations=5)
    result = forecast.forecast_weekly(model, data, "1")
    assert result.count() == 96 and result.filter("is_future AND actual_t IS NULL AND forecast_t IS NOT NULL").count() == 48
    accuracy = forecast.forecast_accuracy(result)
    assert {r.level for r in accuracy.collect()} == {"category", "country_code", "total"}
    assert accuracy.count() == 5
    assert forecast.save_model(model, str(tmp_path), accuracy, {"iterations": 5}) == 1
    assert forecast.save_model(model, str(tmp_path), accuracy, {"iterations": 5}) == 2
    again = forecast.forecast_weekly(forecast.load_model(str(tmp_path), 2), data, "1")
    assert rows(again) == rows(result)


def test_error_measures(spark):
    df = spark.createDataFrame([("w", "c", "k", 10.0, 12.0, 9.0, False), ("w", "c", "k", 30.0, 27.0, 33.0, False)],
                               "week_start string, country_code string, category string, actual_t double, forecast_t double, baseline_t double, is_future boolean")
    total = forecast.forecast_accuracy(df).filter("level = 'total'").first()
    assert (total.wape_pct, total.mape_pct, total.bias_pct) == (12.5, 15.0, -2.5)
