import datetime as dt
import random

import pytest
from conftest import at, day, rows
from pyspark.sql import functions as F

from shelfline.operators import lookup, scd2
from shelfline.operators.scan import ordered_scan

FIELDS = ["name", "chan"]


def brute_history(current, log):
    out = []
    for key, start, name, chan in current:
        mine = sorted(
            (e for e in log if e[1] == key and not (e[3] == e[4] and e[3] is not None)), key=lambda e: (e[5], e[0])
        )
        starts = sorted({start} | {e[5] for e in mine if e[5] > start})
        for i, s in enumerate(starts):
            values = []
            for field, today in (("name", name), ("chan", chan)):
                own = [e for e in mine if e[2] == field]
                past, later = [e for e in own if e[5] <= s], [e for e in own if e[5] > s]
                values.append(past[-1][4] if past else later[0][3] if later else today)
            end = starts[i + 1] if i + 1 < len(starts) else dt.datetime(9999, 12, 31)
            out.append((key, *values, s, end, i + 1 == len(starts), i + 1))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def audit(spark):
    rnd = random.Random(11)
    current = [(k, at("2020-01-01") + dt.timedelta(days=k % 3), f"n{k}", f"c{k}") for k in range(20)]
    log = []
    for i in range(400):
        key = 0 if rnd.random() < 0.4 else rnd.randrange(22)
        moment = at("2019-12-28") + dt.timedelta(days=rnd.randrange(50))
        log.append((i, key, rnd.choice(["name", "chan", "other"]), rnd.choice([None, "a", "b"]), rnd.choice([None, "a", "b"]), moment))
    frames = (
        spark.createDataFrame(current, "k int, start timestamp, name string, chan string"),
        spark.createDataFrame(log, "change_id int, k int, field_name string, old_value string, new_value string, changed_at timestamp"),
    )
    return current, log, *frames


@pytest.mark.parametrize("heavy_rows", [2_000_000, 25])
def test_history_follows_the_rule_whatever_the_slicing(audit, heavy_rows):
    current, log, cur, changes = audit
    built = scd2.rebuild_scd2(cur, scd2.drop_noop(changes), "k", "start", FIELDS, heavy_rows=heavy_rows)
    found = rows(built, "k", *FIELDS, "valid_from", "valid_to", "is_current", "version")
    assert found == brute_history(current, log)


def test_history_does_not_depend_on_row_order_or_partitions(audit):
    _, _, cur, changes = audit
    a = scd2.rebuild_scd2(cur, scd2.drop_noop(changes), "k", "start", FIELDS)
    b = scd2.rebuild_scd2(cur.repartition(5), scd2.drop_noop(changes.repartition(7, "new_value")), "k", "start", FIELDS)
    assert rows(a) == rows(b)


def test_no_op_keeps_null_changes(spark):
    log = spark.createDataFrame([("a", "a"), (None, None), ("a", None), ("a", "b")], "old_value string, new_value string")
    assert rows(scd2.drop_noop(log)) == sorted([(None, None), ("a", None), ("a", "b")], key=str)


def test_customer_and_product_derivations(spark):
    cust = spark.createDataFrame(
        [("1", "Traditional trade", "Modern trade", "Retail chain", "1500.0"), ("2", "Modern trade", "Modern trade", "Retail chain", "7")],
        "customer_id string, channel string, cur_channel string, customer_type string, credit_limit_eur string",
    )
    types = {"Modern trade": "Retail chain", "Traditional trade": "Wholesaler"}
    assert rows(scd2.derive_customer(cust, types), "customer_id", "customer_type", "credit_limit_eur") == [
        ("1", "Wholesaler", 1500),
        ("2", "Retail chain", 7),
    ]
    prod = spark.createDataFrame(
        [("Coffee 180 g", "200 g", "180 g", "9.00"), ("Bar 8 x 14 g", "8 x 14 g", "8 x 14 g", "2.50")],
        "product_name string, pack_size string, cur_pack_size string, case_weight_kg string",
    ).withColumn("case_weight_kg", F.col("case_weight_kg").cast("decimal(9,2)"))
    found = [(r.product_name, float(r.case_weight_kg)) for r in scd2.derive_product(prod).collect()]
    assert sorted(found) == [("Bar 8 x 14 g", 2.5), ("Coffee 200 g", 10.0)]


@pytest.mark.parametrize("heavy_rows", [2_000_000, 10])
def test_overlaps_are_counted_like_all_pairs(spark, heavy_rows):
    rnd = random.Random(5)
    versions = []
    for key in range(5):
        for number in range(1, [2, 3, 9, 40, 1][key] + 1):
            start = at("2020-01-01") + dt.timedelta(days=rnd.randrange(30))
            versions.append((key, number, start, start + dt.timedelta(days=rnd.randrange(-2, 15))))
    pairs = {}
    for a in versions:
        for b in versions:
            if a[0] == b[0] and a[1] < b[1] and a[3] > b[2]:
                pairs[a[0]] = pairs.get(a[0], 0) + 1
    df = spark.createDataFrame(versions, "k int, version int, valid_from timestamp, valid_to timestamp")
    assert {r.k: r.overlaps for r in scd2.count_overlaps(df, "k", heavy_rows).collect()} == pairs


def test_single_current_version_check(spark):
    df = spark.createDataFrame([(1, True), (1, False), (2, True), (2, True), (3, False)], "k int, is_current boolean")
    assert rows(scd2.keys_without_single_current(df, "k")) == [(2, 2), (3, 0)]


@pytest.mark.parametrize("heavy_rows", [2_000_000, 8])
def test_ordered_scan_with_null_keys(spark, heavy_rows):
    rnd = random.Random(2)
    data = [(rnd.choice([None, 1, 1, 2]), i, rnd.choice([None, i])) for i in range(60)]
    df = spark.createDataFrame(data, "k int, i int, v int")
    scanned = ordered_scan(
        df, ["k"], ["i"], carry={"c": F.col("v")}, upcoming={"u": F.col("v")}, running={"s": F.col("v")}, heavy_rows=heavy_rows
    )
    want = []
    for k, i, v in data:
        own = [d for d in data if d[0] == k]
        past = [d[2] for d in own if d[1] <= i and d[2] is not None]
        later = [d[2] for d in own if d[1] > i and d[2] is not None]
        want.append((k, i, v, past[-1] if past else None, later[0] if later else None, sum(past) if past else None))
    assert rows(scanned, "k", "i", "v", "c", "u", "s") == sorted(want, key=str)


@pytest.mark.parametrize("dense", [256, 1])
def test_point_in_time_join(spark, dense):
    versions = spark.createDataFrame(
        [("a", at("2020-01-01"), at("2020-06-01 14:00"), "old"), ("a", at("2020-06-01 14:00"), at("2020-09-01"), "new"), ("b", at("2020-01-01"), at("9999-12-31"), "b")],
        "k string, valid_from timestamp, valid_to timestamp, label string",
    )
    facts = spark.createDataFrame(
        [(1, "a", day("2020-05-31")), (2, "a", day("2020-06-01")), (3, "a", day("2020-06-02")), (4, "a", day("2019-12-31")),
         (5, "a", day("2020-09-01")), (6, "b", day("2021-01-01")), (7, "c", day("2020-05-05")), (8, None, day("2020-05-05"))],
        "id int, k string, d date",
    )
    joined = lookup.pit_join(facts, versions, "k", F.col("d"), {"label": "label"}, dense=dense, heavy_rows=3)
    assert rows(joined, "id", "label") == [
        (1, "old"), (2, "old"), (3, "new"), (4, None), (5, None), (6, "b"), (7, None), (8, None),
    ]


@pytest.mark.parametrize("heavy_rows", [2_000_000, 3])
def test_asof_join_takes_the_newest_value_not_after(spark, heavy_rows):
    prices = spark.createDataFrame([(1, day("2020-01-01"), 10), (1, day("2020-07-01"), 11), (2, day("2020-03-01"), 5)], "sku int, valid_from date, price int")
    facts = spark.createDataFrame(
        [(1, day("2019-12-31")), (1, day("2020-01-01")), (1, day("2020-06-30")), (1, day("2020-07-01")), (2, day("2020-02-01")), (2, day("2021-01-01")), (3, day("2021-01-01"))],
        "sku int, d date",
    )
    found = rows(lookup.asof_join(facts, prices, ["sku"], "d", "valid_from", {"price": "price"}, heavy_rows))
    assert [r[2] for r in found] == [None, 10, 10, 11, None, 5, None]


def test_contiguity_finds_gap_and_overlap(spark):
    prices = spark.createDataFrame(
        [(1, day("2020-01-01"), day("2020-06-30")), (1, day("2020-07-01"), day("9999-12-31")), (2, day("2020-01-01"), day("2020-06-28")),
         (2, day("2020-07-01"), day("9999-12-31")), (3, day("2020-01-01"), day("2020-07-04")), (3, day("2020-07-01"), day("9999-12-31"))],
        "sku int, valid_from date, valid_to date",
    )
    broken = lookup.contiguity(prices, ["sku"]).filter("NOT is_contiguous")
    assert [r.sku for r in broken.orderBy("sku").collect()] == [2, 3]


@pytest.mark.parametrize("dense", [1, 3, 256])
def test_point_in_time_join_does_not_depend_on_the_number_of_versions(spark, dense):
    rng = random.Random(11)
    versions = [("A", 1, 100, "a"), ("A", 2, 3, "b"), ("A", 5, 9, "c"), (None, 0, 100, "o"), ("A", None, 50, "n"), ("A", 7, None, "m")]
    versions += [("B", i, i + 2, f"b{i}") for i in range(0, 40, 4)] + [("B", 9, 9, "empty")]
    versions += [("C", 3, 8, "x"), ("C", 3, 8, "x"), ("C", 8, 9, "y")]
    versions += [("D", a, a + rng.randint(1, 9), f"d{a}") for a in rng.sample(range(40), 12)]
    facts = [(i, k, t) for i, (k, t) in enumerate((k, t) for k in ("A", "B", "C", "D", "E", None) for t in [*range(-1, 45, 2), None])]
    found = lookup.pit_join(
        spark.createDataFrame(facts, "i int, k string, t int"),
        spark.createDataFrame(versions, "k string, valid_from int, valid_to int, label string"),
        "k",
        F.col("t"),
        {"label": "label"},
        dense=dense,
        heavy_rows=5,
    )
    want = []
    for i, k, t in facts:
        hits = [x for key, a, b, x in versions if k is not None and key == k and None not in (a, b, t) and a <= t < b]
        want += [(i, k, t, x) for x in hits or [None]]
    assert rows(found) == sorted(want, key=str)


@pytest.mark.parametrize("heavy_rows", [2, 1000])
def test_asof_join_ties_and_nulls(spark, heavy_rows):
    facts = spark.createDataFrame([("a", 5), ("a", None), (None, 5), ("b", 1)], "k string, t int")
    series = spark.createDataFrame([("a", 5, 1), ("a", 5, 3), ("a", 5, 2), ("a", None, 9), (None, 1, 8), ("b", 2, 4)], "k string, s int, p int")
    found = lookup.asof_join(facts, series, ["k"], "t", "s", {"p": "p"}, heavy_rows)
    assert rows(found) == sorted([("a", 5, 3), ("a", None, None), (None, 5, None), ("b", 1, None)], key=str)
