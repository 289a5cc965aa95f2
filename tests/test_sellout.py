from conftest import day, rows
from pyspark.sql import functions as F

from shelfline.functions import text
from shelfline.operators import sellout
from shelfline.plans import marts
from shelfline.sources.reference_values import alias_map, region_map

GOOD = "7609010000011"


def conform(spark, raw):
    frame = spark.createDataFrame([(*r, "f") for r in raw], ", ".join(f"{c} string" for c in sellout.RAW_COLUMNS))
    products = spark.createDataFrame([(GOOD, 7, 10, "Coffee")], "ean string, sku int, units_per_case int, category string")
    distributors = spark.createDataFrame([("C000751", "PL")], "distributor_id string, country_code string")
    return sellout.conform_sellout(frame, products, alias_map(spark), distributors)


def reason(spark, *raw):
    return conform(spark, [raw]).first()["reject_reason"]


A = ("A", "C000751", "05.01.2025", GOOD, "1.234", "CS", "384,5", "Polska")


def changed(**values):
    row = dict(zip(sellout.RAW_COLUMNS, A, strict=False)) | values
    return tuple(row[c] for c in sellout.RAW_COLUMNS[:8])


def test_each_layout_is_parsed_in_its_own_format(spark):
    raw = [
        A,
        ("B", " c-000751 ", "2025-01-05", "7609 010000011", "50", " pcs ", "5.5", "poland"),
        ("JSON", "C000751", "01/05/2025", GOOD, "12.5", "cases", "", " POL "),
    ]
    valid = sellout.valid_rows(conform(spark, raw))
    assert rows(valid, "layout", "week_ending", "country_code", "qty_cases", "stock_cases") == [
        ("A", day("2025-01-05"), "PL", 1234.0, 384.5),
        ("B", day("2025-01-05"), "PL", 5.0, 0.55),
        ("JSON", day("2025-01-05"), "PL", 12.5, None),
    ]


def test_every_reject_reason(spark):
    cases = {
        "UNKNOWN_DISTRIBUTOR": changed(distributor_raw="C9"),
        "INVALID_DATE": changed(week_raw=""),
        "EAN_SCIENTIFIC_NOTATION": changed(ean_raw="7.60901E+12"),
        "UNKNOWN_EAN": changed(ean_raw="4000000123456"),
        "INVALID_QUANTITY": changed(qty_raw="n/a"),
        "NEGATIVE_QUANTITY": changed(qty_raw="-5"),
        "UNKNOWN_UOM": changed(uom_raw="BOX"),
        "UNKNOWN_COUNTRY": changed(country_raw="Atlantis"),
    }
    for expected, raw in cases.items():
        assert reason(spark, *raw) == expected
    assert reason(spark, *A) is None


def test_other_traps(spark):
    assert reason(spark, *changed(week_raw="2025-01-05")) == "INVALID_DATE"  # another layout's format
    assert reason(spark, *changed(qty_raw="384,0")) == "INVALID_QUANTITY"  # decimal comma is no quantity
    assert reason(spark, *changed(week_raw="", qty_raw="n/a")) == "INVALID_DATE"  # the first rule wins


def test_resent_rows_go_and_corrected_rows_stay(spark):
    weekly, bad = sellout.clean_sellout(
        spark.createDataFrame([(*A, "f1"), (*A, "f2"), (*changed(qty_raw="1.300"), "f3"), (*changed(uom_raw="?"), "f4")],
                              ", ".join(f"{c} string" for c in sellout.RAW_COLUMNS)),
        spark.createDataFrame([(GOOD, 7, 10, "Coffee")], "ean string, sku int, units_per_case int, category string"),
        alias_map(spark),
        spark.createDataFrame([("C000751", "PL")], "distributor_id string, country_code string"),
    )
    assert rows(weekly, "qty_cases", "_source_file") == [(1234.0, "f1"), (1300.0, "f3")]
    assert rows(bad, "reject_reason", "uom_raw", "_source_file") == [("UNKNOWN_UOM", "?", "f4")]
    assert rows(sellout.reject_summary(bad)) == [("UNKNOWN_UOM", "A", 1)]


def test_country_literals(spark):
    aliases = {r.alias: r.country_code for r in alias_map(spark).collect()}
    assert aliases["ÖSTERREICH"] == "AT" and aliases["ESPAÑA"] == "ES" and len(aliases) == 41
    regions = {r.country_code: r.region for r in region_map(spark).collect()}
    assert len(regions) == 12 and regions["SE"] == "Northern Europe"


def test_ean13(spark):
    def digit(body):
        return (10 - (sum(map(int, body[0::2])) + 3 * sum(map(int, body[1::2]))) % 10) % 10

    bodies = [f"7609{n:08d}" for n in range(1_000_001, 1_000_101)]
    good = [(b + str(digit(b)),) for b in bodies]
    bad = [(b + str((digit(b) + 1) % 10),) for b in bodies] + [("12",), ("76090100000x1",), (None,)]
    valid = spark.createDataFrame(good + bad, "c string").select("c", text.ean13_valid(F.col("c")).alias("v"))
    assert {r.c for r in valid.collect() if r.v} == {g[0] for g in good}


def test_sell_in_against_sell_out(spark):
    si = spark.createDataFrame(
        [(day("2025-01-05"), "D", "Coffee", 10, 100.0), (day("2025-01-12"), "D", "Coffee", 5, 50.0)],
        "week_ending date, distributor_id string, category string, sell_in_cases bigint, sell_in_eur double",
    )
    so = spark.createDataFrame(
        [(day("2025-01-05"), "D", "Coffee", 4.0, 8.0), (day("2025-01-26"), "D", "Coffee", 2.0, None), (day("2025-01-05"), "D", "Water", 0.0, 9.0)],
        "week_ending date, distributor_id string, category string, sell_out_cases double, stock_cases double",
    )
    dist = spark.createDataFrame([("D", "Dist", "PL")], "distributor_id string, distributor_name string, country_code string")
    mart = marts.mart_sellin_sellout_weekly(si, so, dist)
    found = rows(mart, "category", "week_ending", "sell_in_cases", "sell_out_cases", "stock_cases", "sell_out_4w_avg", "stock_cover_weeks")
    assert sorted(found) == [
        ("Coffee", day("2025-01-05"), 10, 4.0, 8.0, 4.0, 2.0),
        ("Coffee", day("2025-01-12"), 5, 0.0, None, 2.0, None),
        ("Coffee", day("2025-01-26"), 0, 2.0, None, 2.0, None),
        ("Water", day("2025-01-05"), 0, 0.0, 9.0, 0.0, None),
    ]
