"""Batches brought together in runs: the same rows, fewer files, and still replaceable batch by batch."""

import uuid
from pathlib import Path

import pytest

from clearwell.contracts import Contract
from clearwell.plans import batch
from clearwell.sinks import catalog, compaction

ITEMS = Contract("items", columns={"id": "string", "amount": "double", "date": "date"}, not_null=("id",), date_column="date")
DAYS = ("2024-03-01", "2024-03-02", None)


def write(spark, lake, name, start=0, rows=6, **more):
    values = [
        {"id": None if k % 5 == 4 else f"{name}-{k}", "amount": str(k), "date": DAYS[k % 3]} | more
        for k in range(start, start + rows)
    ]
    schema = "id string, amount string, date string" + "".join(
        f", {key} {'bigint' if isinstance(value, int) else 'string'}" for key, value in more.items()
    )
    batch.run_batch(spark.createDataFrame(values, schema), ITEMS, lake, name)


def shown(spark, lake):
    rows = batch.marked_rows(spark, lake, ITEMS)
    return sorted((tuple(r[c] for c in sorted(rows.columns)) for r in rows.collect()), key=str)


def files(lake, days="*"):
    state = [p for p in Path(lake).glob("table_runs/items/_run=*")]
    live = [p for p in Path(lake).glob("items/_batch=*")]
    return [f for p in (*state, *live) for f in p.rglob(f"day={days}/*.parquet")]


@pytest.fixture
def lake(spark, tmp_path):
    for name in ("a", "b@csv-1", "c"):
        write(spark, str(tmp_path), name)
    return str(tmp_path)


def test_rows_stay_and_files_go(spark, lake):
    before, many = shown(spark, lake), len(files(lake))
    assert batch.compact(spark, lake, ITEMS) == 3
    assert shown(spark, lake) == before
    # The folders taken are there until the next call, for queries planned before.
    assert len(files(lake)) > many
    assert batch.compact(spark, lake, ITEMS) == 0
    assert shown(spark, lake) == before
    assert not list(Path(lake).glob("items/_batch=*"))
    assert len(files(lake, "02")) == 2  # one a zone
    assert len(list(Path(lake).glob("table_states/items/*.json"))) <= 2


@pytest.mark.parametrize("cleared", [False, True])
def test_a_batch_in_a_run_is_replaced(spark, lake, cleared):
    batch.compact(spark, lake, ITEMS)
    if cleared:
        batch.compact(spark, lake, ITEMS)
    others = [row for row in shown(spark, lake) if "a" not in row]
    write(spark, lake, "a", start=30, rows=2)
    again = shown(spark, lake)
    assert [row for row in again if "a" not in row] == others
    assert sorted(row.id for row in batch.clean_rows(spark, lake, ITEMS).where("_batch = 'a'").collect()) == ["a-30", "a-31"]
    write(spark, lake, "d")
    again = shown(spark, lake)
    assert batch.compact(spark, lake, ITEMS) >= 2
    assert shown(spark, lake) == again
    batch.compact(spark, lake, ITEMS)
    assert shown(spark, lake) == again


def test_a_swap_that_did_not_happen_changes_nothing(spark, lake, monkeypatch):
    before = shown(spark, lake)
    monkeypatch.setattr(batch, "save_state", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        batch.compact(spark, lake, ITEMS)
    monkeypatch.undo()
    assert shown(spark, lake) == before
    assert batch.compact(spark, lake, ITEMS) == 3
    assert shown(spark, lake) == before


def test_runs_stay_few(spark, lake):
    wanted = shown(spark, lake)
    for k in range(6):
        write(spark, lake, f"n{k}")
        wanted = shown(spark, lake)
        batch.compact(spark, lake, ITEMS)
        assert shown(spark, lake) == wanted
    state = compaction.state_of(spark, lake, "items")
    sizes = [state.runs[run] for run in sorted(state.runs, key=int)]
    assert all(size > sum(sizes[k + 1 :]) for k, size in enumerate(sizes))


def test_types_that_change_after_a_compaction(spark, lake):
    write(spark, lake, "x", note=7)
    write(spark, lake, "y", note="seven")
    before = shown(spark, lake)
    batch.compact(spark, lake, ITEMS)
    assert shown(spark, lake) == before
    # The batch that brought the number comes again with text.
    write(spark, lake, "x", note="7b")
    notes = batch.marked_rows(spark, lake, ITEMS).where("_batch IN ('x', 'y')").select("note").distinct()
    assert sorted(row.note for row in notes.collect()) == ["7b", "seven"]
    write(spark, lake, "z", note=9)
    after = shown(spark, lake)
    batch.compact(spark, lake, ITEMS)
    assert shown(spark, lake) == after


def test_tables_of_the_catalog(spark, lake):
    database = f"d{uuid.uuid4().hex}"
    catalog.ensure_database(spark, database, f"{lake}/database")

    def ids(view):
        return sorted(row.id or "" for row in spark.sql(f"SELECT id FROM {database}.{view}").collect())

    def wanted(rows):
        return sorted(row.id or "" for row in rows(spark, lake, ITEMS).collect())

    def check(**only):
        batch.register_lake_table(spark, lake, ITEMS, database, **only)
        assert ids("items") == wanted(batch.clean_rows)
        assert ids("items_quarantine") == wanted(batch.quarantine_rows)

    check()
    write(spark, lake, "e")
    check(batch_id="e")
    batch.compact(spark, lake, ITEMS)
    check(batch_id="none")
    write(spark, lake, "a", rows=2)
    check(batch_id="a")
    batch.compact(spark, lake, ITEMS)
    batch.compact(spark, lake, ITEMS)
    check(batch_id="a")


def test_only_the_folders_of_the_batch_are_listed(spark, lake, monkeypatch):
    database = f"d{uuid.uuid4().hex}"
    catalog.ensure_database(spark, database, f"{lake}/database")
    batch.register_lake_table(spark, lake, ITEMS, database)
    for k in range(3):
        Path(lake, f"items/_batch=old{k}/_zone=clean/year=2020/month=01/day=01").mkdir(parents=True)
    write(spark, lake, "new")
    listed = []
    places = batch._places
    monkeypatch.setattr(batch, "_places", lambda spark, path, first: listed.append(first) or places(spark, path, first))
    batch.register_lake_table(spark, lake, ITEMS, database, batch_id="new")
    assert listed == ["new"]
    shown = {row.partition.split("/")[0] for row in spark.sql(f"SHOW PARTITIONS {database}.items_batches").collect()}
    assert "_batch=new" in shown and "_batch=old0" not in shown


def test_a_table_without_batches(spark, tmp_path):
    assert batch.compact(spark, str(tmp_path), ITEMS) == 0
