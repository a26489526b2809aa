"""Columns, publications and files: each batch, table and file on its own."""

import gzip
import json
import logging

import pytest

from clearwell.contracts import ORDERS, Contract, ContractError
from clearwell.plans import batch
from clearwell.sinks import catalog
from clearwell.sinks.manifest import published_rows
from clearwell.sources import files, ledger, readers
from clearwell.streaming import ingest

ITEMS = Contract("items", {"id": "string", "qty": "int"}, not_null=("id",), positive=("qty",))
FREE = Contract("free")
DAYS = ("year", "month", "day", "_batch")


def _run(spark, lake, batch_id, ddl, *rows, contract=ITEMS):
    return batch.run_batch(spark.createDataFrame(rows, ddl), contract, str(lake), batch_id)


def _rows(df, *names):
    return sorted((tuple(r) for r in df.select(*names).collect()), key=str)


def test_columns_of_all_batches_are_read(spark, tmp_path):
    _run(spark, tmp_path, "b1", "id string, note string", ("a", "n"))
    _run(spark, tmp_path, "b2", "id string, rank int, tags array<int>", ("b", 3, [1, 2]))
    _run(spark, tmp_path, "b3", "id string, nothing void", ("c", None))
    rows = batch.clean_rows(spark, str(tmp_path), ITEMS)
    assert rows.columns[:2] == ["id", "qty"] and {"note", "rank", "tags", "nothing"} < set(rows.columns)
    assert _rows(rows, "id", "note", "rank", "tags") == [("a", "n", None, None), ("b", None, 3, [1, 2]), ("c", None, None, None)]
    # A batch that is run again with fewer columns takes its note back.
    _run(spark, tmp_path, "b2", "id string", ("b",))
    assert "rank" not in batch.clean_rows(spark, str(tmp_path), ITEMS).columns


def test_a_column_of_several_types_is_text(spark, tmp_path):
    lake = str(tmp_path)
    _run(spark, lake, "b1", "id string, x int, y double", ("a", 1, 0.5))
    _run(spark, lake, "b2", "id string, x string, y struct<z:int>", ("b", "one", (2,)))
    _run(spark, lake, "b3", "id string, x bigint, y double", ("c", 2**40, 1.5))
    want = [("a", "1", "0.5"), ("b", "one", '{"z":2}'), ("c", str(2**40), "1.5")]
    assert _rows(batch.clean_rows(spark, lake, ITEMS), "id", "x", "y") == want
    asked = batch.clean_rows(spark, lake, ITEMS, "`x` bigint, `w` string")
    assert _rows(asked, "id", "x", "w") == [("a", 1, None), ("b", None, None), ("c", 2**40, None)]
    database = catalog.ensure_database(spark, "drift_db", str(tmp_path / "db"))
    batch.register_lake_table(spark, lake, ITEMS, database)
    assert _rows(spark.table("drift_db.items"), "id", "x", "y") == want


def test_tables_without_a_contract(spark, tmp_path):
    _run(spark, tmp_path, "b1", "`A b` int, c string", (1, "x"), contract=FREE)
    _run(spark, tmp_path, "b2", "c string, d boolean", ("y", True), contract=FREE)
    rows = batch.clean_rows(spark, str(tmp_path), FREE)
    assert _rows(rows, "a_b", "c", "d") == [(1, "x", None), (None, "y", True)]
    database = catalog.ensure_database(spark, "free_db", str(tmp_path / "db"))
    batch.register_lake_table(spark, str(tmp_path), FREE, database)
    assert spark.table("free_db.free").count() == 2


def _publish(spark, tmp_path, contract, source, batch_id="b1"):
    lake, data, bad = (str(tmp_path / name) for name in ("lake", f"data-{contract.name}", "bad"))
    batch.publish_batch(spark, lake, contract, batch_id, data, bad, source)
    return data, bad


@pytest.mark.parametrize("source", ["csv", "s3:orders", "a b/c=d%"])
def test_a_quarantine_that_tables_share(spark, tmp_path, source):
    other = Contract("other", {"id": "string"}, not_null=("id",))
    lake = tmp_path / "lake"
    _run(spark, lake, "b1", "id string, date string", (None, "2024-01-01"), (None, "2024-01-02"), ("x", "2024-01-01"))
    _run(spark, lake, "b1", "id string, date string", (None, "2024-01-01"), contract=other)
    for _ in range(2):
        _publish(spark, tmp_path, ITEMS, source)
        _, bad = _publish(spark, tmp_path, other, source)
    rows = readers.read_partitioned(spark, bad, "`id` string", ("source", *DAYS))
    assert _rows(rows, "source", "day") == [(source, "01"), (source, "01"), (source, "02")]
    # One table has fewer rows the next time; the other keeps its own.
    _run(spark, lake, "b1", "id string, date string", (None, "2024-01-02"))
    _publish(spark, tmp_path, ITEMS, source)
    assert _rows(readers.read_partitioned(spark, bad, "`id` string", ("source", *DAYS)), "day") == [("01",), ("02",)]
    own = published_rows(spark, bad, "`id` string", ("source", *DAYS), table="items")
    assert _rows(own, "day") == [("02",)]


def test_a_publication_that_ends_early(spark, tmp_path, monkeypatch):
    lake = tmp_path / "lake"
    _run(spark, lake, "b1", "id string, date string", ("a", "2024-01-01"), ("b", "2024-01-02"), ("n", None))
    data, _ = _publish(spark, tmp_path, ITEMS, "csv")
    schema = batch.contract_ddl(ITEMS)
    assert _rows(published_rows(spark, data, schema, DAYS), "id") == [("a",), ("b",), ("n",)]
    _run(spark, lake, "b1", "id string, date string", ("c", "2024-01-02"))
    with monkeypatch.context() as patch:
        patch.setattr(batch, "_clear", lambda *_: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError, match="lost"):
            _publish(spark, tmp_path, ITEMS, "csv")
    assert _rows(published_rows(spark, data, schema, DAYS), "id") == [("c",)]
    _publish(spark, tmp_path, ITEMS, "csv")
    assert _rows(readers.read_partitioned(spark, data, schema, DAYS), "id") == [("c",)]


@pytest.mark.parametrize(
    ("text", "options", "names"),
    [
        (b"\xef\xbb\xbfa,b c\n1,2\n", {}, ("a", "b c")),
        (b'\n\n"x,y",z\r\n', {}, ("x,y", "z")),
        (b"a;b;\n", {"sep": ";"}, ("a", "b", "_c2")),
        (gzip.compress(b"a,b\n1,2\n"), {}, ("a", "b")),
    ],
)
def test_headers(spark, tmp_path, text, options, names):
    path = tmp_path / ("f.csv.gz" if text[:2] == b"\x1f\x8b" else "f.csv")
    path.write_bytes(text)
    assert files.csv_header(spark, str(path), options) == names


def _feed(spark, tmp_path, fmt="csv", checkpoint="checkpoint", **more):
    ingest.ingest_available(
        spark, str(tmp_path / "in"), fmt, "id string, qty string", ITEMS, str(tmp_path / "lake"), str(tmp_path / checkpoint), **more
    )
    return batch.clean_rows(spark, str(tmp_path / "lake"), ITEMS)


def test_odd_files_hold_up_no_other(spark, tmp_path, caplog):
    (tmp_path / "in").mkdir()
    whole = gzip.compress(("id,qty\n" + "".join(f"g{k},1\n" for k in range(20_000))).encode())
    content = {
        "a{1}.csv": b"id,qty\na,1\n",
        "b.csv": b"qty,id,more\n2,b,m\n3,c,m,surplus\n",
        "short.csv": b"id,qty\nd\n",
        "cut.csv.gz": whole[: len(whole) // 2],
        "no.csv.gz": b"plain text",
        "binary.csv": b"\0\1\2\n",
        "twice.csv": b"A b,a-b,id,qty\n1,2,t,1\n",
    }
    for name, data in content.items():
        (tmp_path / "in" / name).write_bytes(data)
    with caplog.at_level(logging.WARNING):
        rows = _feed(spark, tmp_path)
    assert _rows(rows, "id", "qty", "more") == [("a", 1, None), ("b", 2, "m"), ("d", None, None)]
    bad = batch.quarantine_rows(spark, str(tmp_path / "lake"), ITEMS)
    assert [(r["_quarantine_reason"], r["_corrupt_record"]) for r in bad.collect()] == [("corrupt_record", "3,c,m,surplus")]
    apart = {r["path"].rsplit("/", 1)[1]: r["fault"] for r in ledger.unreadable_files(spark, str(tmp_path / "lake")).collect()}
    assert set(apart) == {"cut.csv.gz", "no.csv.gz", "binary.csv", "twice.csv"} and "fall together" in apart["twice.csv"]
    # A file that is mended is taken, by the next checkpoint at the latest.
    (tmp_path / "in" / "cut.csv.gz").write_bytes(whole)
    assert _feed(spark, tmp_path, checkpoint="renewed").count() == 20_003
    assert ledger.taken_files(spark, str(tmp_path / "lake")).where("fault IS NULL").count() == 4


def test_strict_feeds_still_refuse(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.csv").write_text("qty\n1\n")
    with pytest.raises(Exception, match="required columns are missing"):
        _feed(spark, tmp_path, strict=True)


def test_fields_nobody_listed(spark, tmp_path):
    (tmp_path / "in").mkdir()
    lines = [{"id": "a", "qty": "1", "note": "n"}, {"id": "b", "qty": 2, "deep": {"x": 1}}]
    (tmp_path / "in/a.jsonl").write_text("\n".join(map(json.dumps, lines)))
    rows = _feed(spark, tmp_path, "jsonl")
    assert _rows(rows.selectExpr("id", "qty", "note", "deep.x"), "id", "qty", "note", "x") == [("a", 1, "n", None), ("b", 2, None, "1")]
    (tmp_path / "in/b.jsonl").write_text("{oops\n")
    (tmp_path / "in/c.jsonl").write_text('{"id": "c", "other": "o"}\n')
    rows = _feed(spark, tmp_path, "jsonl", discover=False)
    assert rows.count() == 3 and "other" not in rows.columns


def test_parquet_files_of_two_shapes(spark, tmp_path):
    spark.createDataFrame([("a", 1)], "id string, qty int").write.parquet(str(tmp_path / "in"))
    spark.createDataFrame([("b", "2", 0.5)], "id string, qty string, x double").write.mode("append").parquet(str(tmp_path / "in"))
    (tmp_path / "in/odd.parquet").write_bytes(b"no parquet file at all")
    rows = _feed(spark, tmp_path, "parquet", pathGlobFilter="*.parquet")
    assert _rows(rows, "id", "qty", "x") == [("a", 1, None), ("b", 2, 0.5)]
    assert ledger.unreadable_files(spark, str(tmp_path / "lake")).count() == 1


def test_a_source_of_two_headers(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.csv").write_text("order_id,customer_id,Note\n1,c,n\n")
    (tmp_path / "in/b.csv").write_text("customer_id,order_id\nd,2\n")
    (tmp_path / "in/c.csv.gz").write_bytes(b"x")
    source = batch.Source(str(tmp_path / "in"), "csv", "orders")
    for mode in ("infer", "text"):
        lake = str(tmp_path / mode)
        assert batch.run_sources(spark, [source], lake, "b1", mode=mode).first()["raw_count"] == 2
        rows = batch.clean_rows(spark, lake, ORDERS)
        assert _rows(rows, "order_id", "customer_id", "note") == [("1", "c", "n"), ("2", "d", None)]
        assert ledger.unreadable_files(spark, lake).count() == 1
    (tmp_path / "none").mkdir()
    (tmp_path / "none/c.csv.gz").write_bytes(b"x")
    with pytest.raises(files.UnreadableFile):
        batch.run_sources(spark, [batch.Source(str(tmp_path / "none"), "csv", "orders")], str(tmp_path / "l"), "b1")


def test_faults_are_told_from_failures():
    assert files.file_fault(ContractError("x")) == "x"
    assert files.file_fault(RuntimeError("FAILED_READ_FILE")) is None
