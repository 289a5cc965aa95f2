"""Governance in SQL, report pages, stories, manifests, documents, evolving tables, partition pruning."""

import json

import pytest
from conftest import day, rows
from pyspark.sql import functions as F

from shelfline.operators import forecast, governance, runlog
from shelfline.plans import kpi, stories
from shelfline.schemas import SELLOUT_JSON
from shelfline.sources import manifest, tables
from shelfline.streaming import ingest


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")


def test_access_rule_and_mask_follow_the_user(spark):
    access = spark.createDataFrame([("anna", "PL"), ("anna", "DE"), ("bob", "ALL"), ("ünï 'x'", "FR")], "user_email string, country_code string")
    readers = spark.createDataFrame([("bob",)], "user_email string")
    governance.install_rules(spark, access, readers)
    sold = [("PL", 1, "Ann"), ("DE", 2, None), ("FR", 3, ""), (None, 4, "x")]
    spark.createDataFrame(sold, "country_code string, amount int, contact string").createOrReplaceTempView("sold_plain")
    governance.secured_sql_view(spark, "sold_secured", "sold_plain", "country_code", ["contact"])

    def seen(user):
        governance.act_as(spark, user)
        return rows(spark.table("sold_secured"), "amount", "contact")

    assert seen("anna") == [(1, "A***"), (2, None)]
    assert seen("bob") == [(1, "Ann"), (2, None), (3, ""), (4, "x")]
    assert seen("ünï 'x'") == [(3, "***")] and seen("nobody") == []
    # the session's own user has no grant until the table says so
    assert seen(None) == []
    me = governance.current_user(spark)
    governance.install_rules(spark, access.union(spark.createDataFrame([(me, "DE")])), readers)
    assert rows(spark.table("sold_secured"), "amount") == [(2,)]
    plan = spark.sql("EXPLAIN SELECT * FROM sold_secured").first()[0]
    assert "CartesianProduct" not in plan


def months(*values):
    return [(day(m), country, channel, category, v) for m, country, channel, category, v in values]


def test_page_of_several_slices_in_one_scan(spark):
    data = months(
        ("2024-01-01", "PL", "Web", "Tea", 10.0), ("2024-02-01", "PL", "Shop", "Tea", 20.0), ("2025-01-01", "PL", "Web", "Tea", 40.0),
        ("2025-01-01", "PL", "Shop", None, 5.0), ("2025-02-01", "DE", "Web", "Tea", 7.0), ("2025-01-01", "FR", "Web", "Tea", 999.0), ("2025-02-01", "PL", "Mail", "Tea", 999.0),
    )
    mart = spark.createDataFrame(data, "month_start date, country_code string, channel string, category string, net_sales_eur double")
    mart = mart.withColumns({c: F.col("net_sales_eur") for c in ("net_sales_cfx_eur", "volume_t", "cogs_eur")})
    slices = [kpi.Slice("total"), kpi.Slice("channel", ("channel",)), kpi.Slice("category", ("category",)), kpi.Slice("both", ("country_code", "channel")), kpi.Slice("month", monthly=True)]
    chosen = kpi.Selection({"country_code": ["PL", "DE"], "channel": ["Web", "Shop"], "category": []}, [2025])
    page = kpi.sales_page(mart, slices, chosen)
    found = {(r.slice, tuple(r.members), str(r.period)): (r.net_sales, r.net_sales_py, None if r.net_sales_share is None else round(r.net_sales_share, 4)) for r in page.collect()}
    assert found == {
        ("total", (), "2025-01-01"): (52.0, 30.0, 1.0),
        ("channel", ("Web",), "2025-01-01"): (47.0, 10.0, 0.9038),
        ("channel", ("Shop",), "2025-01-01"): (5.0, 20.0, 0.0962),
        ("category", ("Tea",), "2025-01-01"): (47.0, 30.0, 0.9038),
        ("category", (None,), "2025-01-01"): (5.0, None, 0.0962),
        ("both", ("PL", "Web"), "2025-01-01"): (40.0, 10.0, 0.7692),
        ("both", ("PL", "Shop"), "2025-01-01"): (5.0, 20.0, 0.0962),
        ("both", ("DE", "Web"), "2025-01-01"): (7.0, None, 0.1346),
        ("month", (), "2025-01-01"): (45.0, 10.0, 1.0),
        ("month", (), "2025-02-01"): (7.0, 20.0, 1.0),
    }
    whole = kpi.page(mart, slices, chosen, "month_start", kpi.sales_sums(), kpi.last_data_date(mart))
    plan = whole._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Expand") == 1 and plan.count("LogicalRDD") == 2  # the mart, and the newest data date


def test_stories_over_several_frames(spark):
    frames = {
        "growth": spark.createDataFrame([("a", 5.0), ("b", 9.0)], "key string, pct double"),
        "empty": spark.createDataFrame([], "v double"),
        "unused": spark.createDataFrame([(1,)], "v int"),
    }
    told = [
        stories.Story("leaders", "growth", stories.leaders("key"), stories.leaders("key") == "a, b"),
        stories.Story("too high", "growth", F.max("pct"), F.max("pct") > 10),
        stories.Story("nothing there", "empty", F.avg("v"), F.avg("v") > 0),
    ]
    assert rows(stories.check_stories(frames, told)) == [("leaders", "a, b", "PASS"), ("nothing there", None, "FAIL"), ("too high", "9.0", "FAIL")]
    assert [r.key for r in stories.top_members(spark.createDataFrame([("a", 1.0), ("c", None), ("b", 1.0)], "key string, growth_pct double"), "key", 2).collect()] == ["a", "b"]


def test_manifest_tells_missing_short_and_unlisted_files(spark, tmp_path):
    put(tmp_path / "files" / "a.csv", "n\n1\n2\n")
    put(tmp_path / "files" / "b.csv", "n\n1\n")
    put(tmp_path / "files" / "d.csv", "n\n1\n")
    put(tmp_path / "manifest" / "m.json", json.dumps({"a.csv": 2, "b.csv": 3}, indent=1))
    put(tmp_path / "manifest" / "n.json", json.dumps({"c.csv": 4}))
    loaded = manifest.loaded_counts(spark.read.option("header", True).csv(str(tmp_path / "files")))
    checked = manifest.manifest_check(manifest.read_manifest(spark, str(tmp_path / "manifest")), loaded)
    found = rows(checked.selectExpr("object_name", "int(source_value) s", "int(target_value) t", "problem", "status"))
    assert found == [("a.csv", 2, 2, None, "PASS"), ("b.csv", 3, 1, "short", "FAIL"), ("c.csv", 4, 0, "missing", "FAIL"), ("d.csv", 0, 1, "unlisted", "FAIL")]


def test_broken_documents_are_set_aside(spark, tmp_path):
    document = {"distributor": "C1", "records": [{"dist": "C1", "sold": str(i)} for i in range(3)]}
    whole = json.dumps(document, indent=2)
    land, good, broken = tmp_path / "landing", str(tmp_path / "good"), str(tmp_path / "broken")

    def run():
        ingest.run_documents(ingest.documents_stream(spark, str(land), SELLOUT_JSON, "*.json"), good, broken, str(tmp_path / "cp"))
        return spark.read.parquet(good).count(), sorted(r._source_file.rsplit("/", 1)[1] for r in spark.read.parquet(broken).collect())

    land.mkdir()
    assert run() == (0, [])
    put(land / "a.json", whole)
    put(land / "b.json", whole[:-9])
    put(land / "c.json", whole.replace("C1", "C2"))
    assert run() == (6, ["b.json"])
    assert spark.read.parquet(broken).first().document == whole[:-9]
    put(land / "d.json", "[1, 2")
    assert run() == (6, ["b.json", "d.json"])
    assert {"_source_file", "_file_modified", "_ingested_at"} <= set(spark.read.parquet(good).columns)


def test_a_table_gains_columns_and_refuses_other_types(spark, tmp_path):
    path = str(tmp_path / "t")
    assert tables.append_evolving(spark.createDataFrame([(1, "x")], "a int, b string"), path) == 1
    assert tables.append_evolving(spark.createDataFrame([("y", 2.5, 2)], "b string, c double, a int"), path) == 1
    assert tables.append_evolving(spark.createDataFrame([(3,)], "a int"), path) == 1
    assert rows(tables.read_evolving(spark, path), "a", "b", "c") == [(1, "x", None), (2, "y", 2.5), (3, None, None)]
    with pytest.raises(tables.TypeConflict, match="a: int is stored, string comes"):
        tables.append_evolving(spark.createDataFrame([("4",)], "a string"), path)
    assert tables.read_evolving(spark, path).count() == 3


def test_a_stream_gains_a_column(spark, tmp_path):
    put(tmp_path / "one" / "x.json", '{"a": 1}\n')
    put(tmp_path / "two" / "x.json", '{"a": 2, "d": "new"}\n')
    for name, schema in (("one", "a int"), ("two", "a int, d string")):
        stream = ingest.file_stream(spark, str(tmp_path / name), "json", schema)
        assert ingest.run_evolving(stream, str(tmp_path / "t"), str(tmp_path / "cp" / name)) == [1]
        assert ingest.run_evolving(stream, str(tmp_path / "t"), str(tmp_path / "cp" / name)) == []
    assert rows(tables.read_evolving(spark, str(tmp_path / "t")), "a", "d") == [(1, None), (2, "new")]
    wrong = ingest.file_stream(spark, str(tmp_path / "two"), "json", "a string")
    with pytest.raises(Exception, match="int is stored"):
        ingest.run_evolving(wrong, str(tmp_path / "t"), str(tmp_path / "cp" / "wrong"))


def test_a_calendar_prunes_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    facts = spark.range(100).selectExpr("id", "date_add(DATE'2025-01-01', int(id % 10)) AS d")
    tables.write_table(facts, path, ["d"])
    spark.range(30).selectExpr("date_add(DATE'2025-01-01', int(id)) AS date").write.parquet(str(tmp_path / "calendar"))
    calendar = spark.read.parquet(str(tmp_path / "calendar")).filter("dayofmonth(date) IN (2, 4, 20)")
    found = tables.read_pruned(spark, path, "d", calendar, "date")
    assert rows(found.groupBy("d").count()) == [(day("2025-01-02"), 10), (day("2025-01-04"), 10)]
    assert "dynamicpruning" in found._jdf.queryExecution().executedPlan().toString()


def test_newest_run_of_each_log(spark):
    log = lambda *r: spark.createDataFrame([(*x[:3], day(x[3])) for x in r], "run_id string, status string, difference double, checked_at date")
    recon = log(("r1", "FAIL", -3.0, "2025-01-01"), ("r2", "PASS", 0.0, "2025-01-02"), ("r2", "FAIL", -2.0, "2025-01-02"))
    checks = log(("r3", "PASS", 0.0, "2025-01-09"))
    found = rows(runlog.result_kpis({"recon": recon, "checks": checks}))
    assert found == [("checks", "r3", 1, 1, 1.0, 0.0), ("recon", "r2", 2, 1, 0.5, 2.0)]


def test_boosting_ends_when_the_last_weeks_do_not_gain(spark):
    data = spark.range(600).selectExpr(
        "date_add(DATE'2023-01-02', 7 * int(id / 4)) AS week_start", "concat('C', id % 2) AS country_code", "concat('K', int(id / 2) % 2) AS category",
        "10.0 + (id % 4) AS volume_t", *[f"double(id % 4) AS {c}" for c in forecast.FEATURES if c not in ("promo_lag12", "temp_clim_c")], "CAST(NULL AS DOUBLE) AS promo_lag12", "CAST(NULL AS DOUBLE) AS temp_clim_c",
        "CASE WHEN id < 560 THEN 'train' ELSE 'test' END AS role",
    )
    marked = forecast.with_validation(data)
    assert marked.filter("is_validation").count() == 48 and marked.count() == 560
    rounds = forecast.rounds_needed(data, 12)
    assert 1 <= rounds <= 12
    model = forecast.train(data, 12)
    assert model.stages[-1].getNumTrees == rounds
    errors = forecast.forecast_accuracy(forecast.forecast_weekly(model, data, "1")).filter("level = 'total'").first()
    assert errors.wape_pct < 10
    short = data.filter("week_start >= DATE'2025-08-25'")  # all of it is validation: nothing to stop by
    assert forecast.rounds_needed(short, 3) == 3


def test_rolling_mean_differs_from_the_baseline(spark):
    data = spark.createDataFrame([("test", 4.0, 3.0, 2.0005), ("future", None, 3.0, 1.0)], "role string, volume_t double, lag_52 double, roll4_lag12 double").selectExpr(
        "DATE'2025-01-06' AS week_start", "'PL' AS country_code", "'Tea' AS category", "*"
    )
    found = forecast.rolling_mean(data)
    assert rows(found, "actual_t", "forecast_t", "baseline_t", "is_future") == [(4.0, 2.001, 3.0, False), (None, 1.0, 3.0, True)]
    total = forecast.forecast_accuracy(found).filter("level = 'total'").first()
    assert (total.wape_pct, total.bias_pct) == (49.98, -49.98)
    figures = kpi.forecast_kpis(found).first()
    assert figures.forecast_accuracy == 0.50025 and figures.baseline_accuracy == 0.75 and figures.baseline_bias == -0.25
