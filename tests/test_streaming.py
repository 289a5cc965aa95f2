import json

from conftest import day, rows
from pyspark.sql import functions as F

from shelfline.schemas import SELLOUT_A, SELLOUT_B, SELLOUT_JSON
from shelfline.streaming import event_table
from shelfline.streaming import events as pos
from shelfline.streaming import ingest


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")


def test_layouts_in_one_folder_and_restart(spark, tmp_path):
    land = tmp_path / "landing"
    head_a = "Distributor;Week_Ending;EAN;Product_Desc;Qty_Sold;UoM;Closing_Stock;Country\n"
    head_b = "distributor_id,week_end_date,gtin,description,units_sold,unit,stock_on_hand,country\n"
    put(land / "C1" / "sellout_C1_2025-01.csv", head_a + "C1;05.01.2025;76;Ä;1.234;CS;384,0;Österreich\n")
    put(land / "C2" / "c000002_202501.csv", head_b + "c-2,2025-01-05,76,x,5,EA,1.5,DE\n")
    document = {"distributor": "C3", "generated_at": "t", "records": [{"dist": "C3", "period_end": "01/05/2025", "barcode": "76", "sold": 5, "uom": "CS", "stock": 1.5, "market": "PL"}] * 2}
    put(land / "C3" / "sellout_2025-01.json", json.dumps(document, indent=2))

    def run_a():
        stream = ingest.csv_stream(spark, str(land), SELLOUT_A, "sellout_C*.csv", ";")
        return ingest.run_available_now(stream, str(tmp_path / "a"), str(tmp_path / "cp_a"))

    assert run_a() == 1
    stream_b = ingest.csv_stream(spark, str(land), SELLOUT_B, "c0*.csv", ",")
    assert ingest.run_available_now(stream_b, str(tmp_path / "b"), str(tmp_path / "cp_b")) == 1
    stream_j = ingest.json_records_stream(spark, str(land), SELLOUT_JSON, "sellout_*.json")
    assert ingest.run_available_now(stream_j, str(tmp_path / "j"), str(tmp_path / "cp_j")) == 2
    found = rows(spark.read.parquet(str(tmp_path / "j")), "distributor", "dist", "sold", "stock", "market")
    assert found == [("C3", "C3", "5", "1.5", "PL")] * 2
    # nothing new, then one new file
    assert run_a() == 0
    put(land / "C1" / "sellout_C1_2025-02.csv", head_a + "C1;02.02.2025;76;x;7;CS;1,0;AT\n" * 1 + "C1;09.02.2025;76;x;8;CS;1,0;AT\n")
    assert run_a() == 2
    table = spark.read.parquet(str(tmp_path / "a"))
    assert rows(table, "Qty_Sold") == [("1.234",), ("7",), ("8",)]
    assert table.select("Country").filter("Country = 'Österreich'").count() == 1
    assert {"_source_file", "_file_modified", "_ingested_at"} <= set(table.columns)
    counted = ingest.layout_counts(spark, {"A": str(tmp_path / "a"), "JSON": str(tmp_path / "j")})
    assert rows(counted) == [("A", 3, 2), ("JSON", 2, 1)]


def event(number, **more):
    base = {"event_id": f"e{number}", "event_type": "purchase", "event_ts": "2025-09-14T23:30:00Z", "retailer_id": "R", "country": "PL", "ean": "1", "quantity": 2, "unit_price": 1.5, "currency": "PLN"}
    return json.dumps(base | more) + "\n"


def test_rescue_keeps_unknown_and_misfit_fields(spark):
    lines = spark.createDataFrame([(event(1, device="ios"),), (event(2, quantity="many"),), ("no json",), (event(3),)], "value string")
    found = pos.parse_with_rescue(lines).collect()
    assert json.loads(found[0][pos.RESCUED]) == {"device": "ios"}
    assert found[1].quantity is None and json.loads(found[1][pos.RESCUED]) == {"quantity": "many"}
    assert found[1].unit_price == 1.5
    assert found[2].event_id is None and found[2][pos.RESCUED] == "no json"
    assert found[3][pos.RESCUED] is None
    typed = spark.createDataFrame([("web", None), (None, '{"device":"ios"}')], f"device string, {pos.RESCUED} string")
    assert rows(typed.select(pos.promoted(typed, "device").alias("d"))) == [("ios",), ("web",)]


def test_events_across_runs(spark, tmp_path):
    land, bronze, silver, check = (tmp_path / n for n in ("land", "bronze", "silver", "cp"))

    def run():
        pos.run_upsert(pos.read_event_stream(spark, str(land)), str(bronze), str(silver), str(check))
        return spark.read.parquet(str(silver))

    put(land / "date=2025-09-14" / "events_0.jsonl", event(1) + event(1) + event(2))
    assert rows(run(), "event_id") == [("e1",), ("e2",)]
    # a copy of an old event, a late one, a new field
    put(land / "date=2025-09-15" / "events_0.jsonl", event(2) + event(3, device="ios") + event(4, event_ts="2025-09-15T00:00:01Z"))
    found = run()
    assert rows(found, "event_id", "device", "is_late", "file_date") == [
        ("e1", None, False, day("2025-09-14")),
        ("e2", None, False, day("2025-09-14")),
        ("e3", "ios", True, day("2025-09-15")),
        ("e4", None, False, day("2025-09-15")),
    ]
    assert spark.read.option("mergeSchema", "true").parquet(str(bronze)).count() == 6
    assert run().count() == 4
    summary = pos.stream_summary(found)
    assert rows(summary) == [("2025-09", 2, 4, 1, 1)]


def test_retried_batch_changes_nothing(spark, tmp_path):
    write = pos.upsert_batch(str(tmp_path / "bronze"), str(tmp_path / "silver"))
    lines = lambda text: pos.parse_with_rescue(
        spark.createDataFrame([(line,) for line in text.splitlines()], "value string").withColumns(
            {"_source_file": F.lit("date=2025-09-14/f"), "_ingested_at": F.current_timestamp()}
        )
    )
    write(lines(event(1) + event(2)), 0)
    write(lines(event(2) + event(3)), 1)
    once = rows(spark.read.parquet(str(tmp_path / "silver")), "event_id", "batch_id")
    write(lines(event(2) + event(3)), 1)
    assert rows(spark.read.parquet(str(tmp_path / "silver")), "event_id", "batch_id") == once == [("e1", 0), ("e2", 0), ("e3", 1)]
    assert spark.read.parquet(str(tmp_path / "bronze")).count() == 4


def test_histories_of_two_checkpoints_are_kept(spark, tmp_path):
    land, bronze, silver = (tmp_path / n for n in ("land", "bronze", "silver"))

    def run(check):
        return pos.run_upsert(pos.read_event_stream(spark, str(land)), str(bronze), str(silver), str(tmp_path / check))

    put(land / "date=2025-09-14" / "events_0.jsonl", event(1) + event(2))
    assert run("first") == 2
    put(land / "date=2025-09-15" / "events_0.jsonl", event(2) + event(3))
    # the checkpoint is lost: everything is read again, and only the new event is added
    assert run("second") == 1
    assert rows(spark.read.parquet(str(silver)), "event_id") == [("e1",), ("e2",), ("e3",)]
    assert spark.read.parquet(str(bronze)).count() == 2 + 4
    put(land / "date=2025-09-16" / "events_0.jsonl", event(3) + event(4))
    assert (run("first"), run("second")) == (1, 0)
    assert rows(spark.read.parquet(str(silver)), "event_id") == [("e1",), ("e2",), ("e3",), ("e4",)]


def test_batches_do_not_read_a_growing_history(spark, tmp_path, monkeypatch):
    """Files of the history that a batch reads, while the history grows tenfold: none of the stream's own; those of
    another checkpoint stay few because of compaction."""
    land, bronze, silver = (str(tmp_path / n) for n in ("land", "bronze", "silver"))
    read, stored = [], event_table.stored

    def watched(*args, **more):
        known = stored(*args, **more)
        read.append(0 if known is None else len(known.inputFiles()))
        return known

    def run(check):
        return pos.run_upsert(pos.read_event_stream(spark, land), bronze, silver, str(tmp_path / check))

    monkeypatch.setattr(event_table, "stored", watched)
    for i in range(10):
        put(tmp_path / "land" / f"date=2025-09-{i + 10}" / "events.jsonl", "".join(event(n) for n in range(5 * i, 5 * i + 10)))
        assert run("first") == (10 if i == 0 else 5)
    assert read == [0] * 10
    read.clear()
    assert event_table.compact(spark, silver).covered and event_table.compact(spark, silver) is None
    read.clear()
    assert run("second") == 0
    assert len(read) == 1 and read[0] <= 1 + spark.sparkContext.defaultParallelism  # a segment and the newest batch
    assert sorted(r[0] for r in event_table.read_events(spark, silver).select("event_id").collect()) == sorted(f"e{n}" for n in range(55))


def test_readers_during_compaction_see_each_event_once(spark, tmp_path, monkeypatch):
    write = pos.upsert_batch(str(tmp_path / "bronze"), str(tmp_path / "silver"))
    silver = str(tmp_path / "silver")

    def load(batch, numbers):
        text = "".join(event(n) for n in numbers)
        lines = spark.createDataFrame([(line,) for line in text.splitlines()], "value string")
        write(pos.parse_with_rescue(lines.withColumns({"_source_file": F.lit("date=2025-09-14/f"), "_ingested_at": F.current_timestamp()})), batch)

    def ids():
        return sorted(r[0] for r in event_table.read_events(spark, silver).select("event_id").collect())

    for i in range(4):
        load(i, range(3 * i, 3 * i + 4))
    begun, want = event_table.read_events(spark, silver), sorted(f"e{n}" for n in range(13))
    assert ids() == want
    publish, seen = event_table.publish, []

    def late(*args):
        seen.append(ids())  # the segment is written, the manifest is not
        publish(*args)

    monkeypatch.setattr(event_table, "publish", late)
    new = event_table.compact(spark, silver)
    assert seen == [want] and ids() == want and begun.count() == 13 and new.covered == {"no-stream": 2}
    # a retried batch that the segment holds, new batches, and a second compaction by another writer
    load(2, range(6, 10))
    load(4, [12, 13])
    assert ids() == sorted(f"e{n}" for n in range(14))
    try:
        publish(spark, silver, new)
        raise AssertionError("two manifests of one version")
    except RuntimeError:
        pass
    assert event_table.vacuum(spark, silver) == 3 and ids() == sorted(f"e{n}" for n in range(14))
    for i in range(5, 8):
        load(i, [i + 10])
        event_table.compact(spark, silver, most_segments=2)
        assert len(event_table.manifest(spark, silver).segments) <= 2 and len(ids()) == 10 + i
    event_table.vacuum(spark, silver)
    assert len(ids()) == 17


def test_events_without_an_id_are_all_new(spark, tmp_path):
    put(tmp_path / "land" / "date=2025-09-14" / "e.jsonl", event(1) + '{"event_type": "purchase"}\n')
    run = lambda: pos.run_upsert(pos.read_event_stream(spark, str(tmp_path / "land")), str(tmp_path / "b"), str(tmp_path / "s"), str(tmp_path / "c"))
    assert run() == 2
    put(tmp_path / "land" / "date=2025-09-15" / "e.jsonl", event(1) + '{"event_type": "return"}\n')
    assert run() == 1


def test_disk_state_leaves_the_session_alone(spark):
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    assert pos.disk_state_session(spark).conf.get(key) != before and spark.conf.get(key) == before


def test_stateful_dedup_survives_a_restart(spark, tmp_path):
    land = tmp_path / "land"

    def run():
        stream = pos.dedup_events(pos.conform_events(pos.read_event_stream(spark, str(land))))
        return ingest.run_available_now(stream, str(tmp_path / "out"), str(tmp_path / "cp"))

    put(land / "date=2025-09-14" / "events_0.jsonl", event(1) + event(1))
    assert run() == 1
    put(land / "date=2025-09-15" / "events_0.jsonl", event(1) + event(2))
    assert run() == 1
    bounded = pos.dedup_events(pos.conform_events(pos.read_event_stream(spark, str(land))), within="1 day")
    assert ingest.run_available_now(bounded, str(tmp_path / "out2"), str(tmp_path / "cp2")) == 2
