import gzip
import json
import os
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from clearwell.contracts import EVENTS, ORDERS
from clearwell.plans import batch
from clearwell.sinks.writers import BATCH
from clearwell.sources import readers
from clearwell.streaming import ingest
from tests import fixtures

COLUMNS = ("event_id", "user_id", "event_type", "timestamp")


def _file(landing, name, ids, user="u"):
    landing.mkdir(exist_ok=True)
    rows = [
        dict(zip(COLUMNS, (f"e{i}", user, "click", f"2024-01-{i % 28 + 1:02d}T00:00:00Z"), strict=True)) for i in ids
    ]
    (landing / name).write_text("\n".join(json.dumps(r) for r in rows))


@pytest.fixture
def take(spark, tmp_path):
    def run(**more):
        ingest.ingest_available(
            spark, str(tmp_path / "in"), "jsonl", readers.text_schema(COLUMNS), EVENTS,
            str(tmp_path / "lake"), str(tmp_path / "checkpoint"), **more,
        )
        return batch.clean_rows(spark, str(tmp_path / "lake"), EVENTS, "`_source_file` string")

    return run


def test_each_file_is_taken_once(spark, tmp_path, take):
    _file(tmp_path / "in", "a.jsonl", range(10))
    assert take().count() == 10
    assert take().count() == 10
    _file(tmp_path / "in", "b.jsonl", range(10, 15))
    rows = take()
    assert rows.count() == 15
    assert {r[0].rsplit("/", 1)[1] for r in rows.select("_source_file").distinct().collect()} == {"a.jsonl", "b.jsonl"}
    assert batch.quality_runs(spark, str(tmp_path / "lake")).count() == 2


def test_lost_commit_is_replayed_in_place(tmp_path, take):
    _file(tmp_path / "in", "a.jsonl", range(10))
    take()
    _file(tmp_path / "in", "b.jsonl", range(10, 15))
    take()
    for name in ("1", ".1.crc"):
        (Path(tmp_path) / "checkpoint/commits" / name).unlink()
    rows = take()
    assert rows.count() == 15
    names = sorted(r[0] for r in rows.select(BATCH).distinct().collect())
    assert [name[-9:] for name in names] == ["-00000000", "-00000001"] and names[0][:-9] == names[1][:-9]


def test_result_does_not_depend_on_micro_batches(tmp_path, take):
    for n in range(4):
        _file(tmp_path / "in", f"{n}.jsonl", [1, 1, 2, n + 3])
    rows = take(max_files=1)
    assert rows.select(BATCH).distinct().count() == 4
    assert rows.count() == 12


def test_bytes_limit_and_prepared_rows(spark, tmp_path, take):
    for n in range(3):
        _file(tmp_path / "in", f"{n}.jsonl", range(n * 10, n * 10 + 10))
    rows = take(max_bytes=1, prepare=lambda df: df.filter("event_id != 'e0'"))
    assert rows.count() == 29
    assert rows.select(BATCH).distinct().count() == 3


def test_bad_rows_of_a_stream_are_kept_apart(spark, tmp_path, take):
    _file(tmp_path / "in", "a.jsonl", range(3))
    _file(tmp_path / "in", "b.jsonl", range(3, 5), user=None)
    assert take().count() == 3
    bad = batch.quarantine_rows(spark, str(tmp_path / "lake"), EVENTS, "`_source_file` string")
    assert {r["_quarantine_reason"] for r in bad.collect()} == {"null:user_id"}


def test_dedup_across_files(spark, tmp_path, caplog):
    schema = "id string, ts timestamp"
    landing, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))

    def land(*rows):
        df = spark.createDataFrame(rows, "id string, ts string").selectExpr("id", "cast(ts as timestamp) ts")
        df.coalesce(1).write.mode("append").parquet(landing)

    def take():
        stream = readers.stream_source(spark, landing, "parquet", schema)
        fresh = ingest.deduplicate_stream(stream, ("id",), "ts", "1 hour").selectExpr("*", "'x' AS part")
        ingest.append_available(fresh, out, checkpoint, ("part",))
        back = readers.read_partitioned(spark, out, "`id` string, `ts` timestamp", (BATCH, "part"))
        return sorted(r["id"] for r in back.collect())

    land(("a", "2024-01-01 10:00:00"), ("a", "2024-01-01 10:05:00"), ("b", "2024-01-01 10:10:00"))
    assert take() == ["a", "b"]
    land(("a", "2024-01-01 10:20:00"), ("c", "2024-01-01 10:30:00"))
    assert take() == ["a", "b", "c"]
    assert "watermark" not in caplog.text
    land(("d", "2024-01-01 08:00:00"), ("e", "2024-01-01 10:40:00"))
    assert take() == ["a", "b", "c", "e"]
    assert "1 rows came after the watermark" in caplog.text


def test_rows_without_an_id_pass_the_dedup(spark, tmp_path):
    rows = [(None, 1, "2024-01-01 10:00:00"), (None, 2, "2024-01-01 10:00:00"), ("a", 3, "2024-01-01 10:00:00")] * 2
    df = spark.createDataFrame(rows, "id string, n int, ts string").selectExpr("id", "n", "cast(ts as timestamp) ts")
    df.write.parquet(str(tmp_path / "in"))
    stream = readers.stream_source(spark, str(tmp_path / "in"), "parquet", df.schema)
    fresh = ingest.deduplicate_stream(stream, ("id",), "ts", "1 hour").withColumn("part", F.lit("x"))
    assert ingest.append_available(fresh, str(tmp_path / "out"), str(tmp_path / "checkpoint"), ("part",)) == 0
    back = spark.read.parquet(str(tmp_path / "out"))
    assert sorted((r["id"] or "", r["n"]) for r in back.collect()) == [("", 1), ("", 1), ("", 2), ("", 2), ("a", 3)]


def test_late_rows_are_counted_over_all_micro_batches(spark, tmp_path):
    landing = tmp_path / "in"
    landing.mkdir()
    for n in range(6):
        # From the third file on, one row of each is a day too late.
        late = f'{{"id": "l{n}", "ts": "2024-01-01T00:00:00Z"}}\n' if n > 1 else ""
        (landing / f"{n}.json").write_text(late + f'{{"id": "r{n}", "ts": "2024-02-0{n + 1}T00:00:00Z"}}\n')
        os.utime(landing / f"{n}.json", (1_700_000_000 + n, 1_700_000_000 + n))
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    try:
        stream = readers.stream_source(spark, str(landing), "jsonl", "id string, ts timestamp", max_files=1)
        fresh = ingest.deduplicate_stream(stream, ("id",), "ts", "1 hour").withColumn("part", F.lit("x"))
        dropped = ingest.append_available(fresh, str(tmp_path / "out"), str(tmp_path / "checkpoint"), ("part",))
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")
    assert dropped == 4


def test_text_that_does_not_parse_is_kept(spark, tmp_path, take):
    (tmp_path / "in").mkdir()
    good = '{"event_id": "e1", "user_id": "u", "event_type": "click", "timestamp": "2024-01-01T00:00:00Z"}'
    (tmp_path / "in/a.jsonl").write_text("{oops\n" + good + "\n")
    assert take().count() == 1
    bad = batch.quarantine_rows(spark, str(tmp_path / "lake"), EVENTS, f"`{readers.CORRUPT}` string").collect()
    assert [(r["_quarantine_reason"], r[readers.CORRUPT]) for r in bad] == [("corrupt_record", "{oops")]


def test_another_checkpoint_replaces_nothing(spark, tmp_path, take):
    _file(tmp_path / "in", "a.jsonl", range(10))
    take()
    (tmp_path / "in/a.jsonl").unlink()
    _file(tmp_path / "in", "b.jsonl", range(10, 12))
    ingest.ingest_available(
        spark, str(tmp_path / "in"), "jsonl", readers.text_schema(COLUMNS), EVENTS, str(tmp_path / "lake"), str(tmp_path / "renewed")
    )
    assert batch.clean_rows(spark, str(tmp_path / "lake"), EVENTS).count() == 12


def test_feeds_of_one_table_and_format_need_names(spark, tmp_path):
    feed = ingest.Feed("csv", ORDERS, readers.text_schema(ORDERS.columns))
    with pytest.raises(ValueError, match="names"):
        ingest.ingest_feeds(spark, str(tmp_path), [feed, feed], str(tmp_path / "lake"), str(tmp_path / "checkpoint"))


def test_raw_zone(spark, tmp_path):
    landing = tmp_path / "in"
    landing.mkdir()
    (landing / "a.csv").write_text("id,qty\n007,x\n")
    (landing / "skip.txt").write_text("id,qty\n1,1\n")
    for _ in range(2):
        ingest.land_raw(
            spark, str(landing), "csv", readers.text_schema(("id", "qty")), str(tmp_path / "raw"),
            str(tmp_path / "checkpoint"), pathGlobFilter=readers.name_glob("csv"),
        )
    rows = readers.read_partitioned(
        spark, str(tmp_path / "raw"), "`id` string, `qty` string, `_source_file` string",
        (BATCH, "format", "year", "month", "day"),
    ).collect()
    assert [(r["id"], r["qty"], r["format"], len(r["day"])) for r in rows] == [("007", "x", "csv", 2)]
    assert rows[0]["_source_file"].endswith("a.csv")


def test_folder_of_mixed_uploads(spark, tmp_path):
    uploads = tmp_path / "uploads"
    uploads.mkdir()
    (uploads / "orders.csv").write_text(fixtures.orders_csv())
    (uploads / "late.csv.gz").write_bytes(gzip.compress(fixtures.orders_csv().replace("G-", "Z-").encode()))
    (uploads / "events.json").write_text(fixtures.events_json())
    more = "\n".join(json.dumps(r | {"event_id": r["event_id"] + "L"}) for r in json.loads(fixtures.events_json()))
    (uploads / "more.jsonl").write_text(more)
    (uploads / "report.xlsx").write_text("no data")
    feeds = [
        ingest.Feed("csv", ORDERS, readers.text_schema(ORDERS.columns)),
        ingest.Feed("json", EVENTS, readers.text_schema(EVENTS.columns)),
        ingest.Feed("jsonl", EVENTS, readers.text_schema(EVENTS.columns)),
    ]
    lake = str(tmp_path / "lake")
    for _ in range(2):
        ingest.ingest_feeds(spark, str(uploads), feeds, lake, str(tmp_path / "checkpoint"))
    orders = batch.clean_rows(spark, lake, ORDERS)
    assert {r["order_id"][:2] for r in orders.collect()} == {"G-", "Z-"}
    assert (orders.count(), batch.clean_rows(spark, lake, EVENTS).count()) == (18, 14)
    assert orders.filter("quantity IS NULL OR created_at IS NULL OR total_amount IS NULL").count() == 0
