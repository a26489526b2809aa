from datetime import UTC, datetime
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from clearwell.__main__ import main
from clearwell.contracts import EVENTS, ORDERS, Contract, ContractError
from clearwell.functions.values import exact_sum
from clearwell.operators import shape
from clearwell.plans import batch, reports
from clearwell.sinks import catalog
from clearwell.sinks.writers import BATCH
from clearwell.sources import readers
from tests import fixtures

ITEMS = Contract("items", {"id": "string", "qty": "int"}, not_null=("id",), positive=("qty",))


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    """The two sample sources, orders with the fault rows, run once."""
    root = tmp_path_factory.mktemp("samples")
    (root / "orders.csv").write_text(fixtures.orders_csv())
    (root / "events.json").write_text(fixtures.events_json())
    faults = spark.createDataFrame(fixtures.FAULTS, fixtures.FAULT_DDL)
    sources = [
        batch.Source(str(root / "orders.csv"), "csv", "orders", more=faults),
        batch.Source(str(root / "events.json"), "json", "events"),
    ]
    path = str(root / "lake")
    summary = batch.run_sources(spark, sources, path, "run1")
    return path, {r["table"]: r.asDict() for r in summary.collect()}


def test_summary_of_the_sample_run(lake):
    _, summary = lake
    orders, events = summary["orders"], summary["events"]
    assert (orders["raw_count"], orders["clean_count"], orders["quarantine_count"]) == (13, 10, 2)
    assert (orders["duplicate_count"], orders["pass_rate_pct"], orders["below_threshold"]) == (1, 76.92, True)
    assert (events["raw_count"], events["clean_count"], events["quarantine_count"]) == (7, 7, 0)
    assert (events["pass_rate_pct"], events["below_threshold"]) == (100.0, False)


def test_reasons_of_the_sample_run(spark, lake):
    bad = batch.quarantine_rows(spark, lake[0], ORDERS)
    assert {(r["order_id"], r["_quarantine_reason"]) for r in bad.collect()} == {
        (None, "null:order_id"),
        ("G-ZERO", "non_positive:quantity"),
    }
    good = batch.clean_rows(spark, lake[0], ORDERS)
    assert good.columns == [*ORDERS.columns, BATCH, "year", "month", "day"]
    assert good.filter("order_id = 'G-TWO'").count() == 1


def _sample_orders(spark, lake):
    return batch.clean_rows(spark, lake[0], ORDERS).filter("order_id != 'G-TWO'")


def _rows(df, digits=6):
    return [tuple(round(v, digits) if isinstance(v, float) else v for v in r) for r in df.collect()]


def test_daily_revenue(spark, lake):
    got = _rows(reports.daily_revenue(_sample_orders(spark, lake)).drop("year", "month"))
    assert got == [
        ("03", 2, 43.5, 21.75, 2),
        ("04", 1, 18.9, 18.9, 1),
        ("07", 3, 154.35, 51.45, 3),
        ("29", 2, 143.49, 71.745, 2),
    ]
    assert [r[3] for r in _rows(reports.revenue_by_day(_sample_orders(spark, lake)))] == [r[2] for r in got]


def test_top_products(spark, lake):
    orders = _sample_orders(spark, lake)
    wanted = [
        ("Wheelbarrow", 1, 1, 139.99),
        ("Trellis", 1, 2, 88.0),
        ("Clay Pot", 2, 10, 65.0),
        ("Seed Tray", 1, 10, 17.5),
    ]
    assert _rows(reports.top_products(orders)) == wanted
    assert _rows(reports.top_of_totals(reports.product_totals(orders, "product_name"))) == wanted
    assert _rows(reports.top_products(orders, k=2)) == wanted[:2]


def test_customer_history(spark, lake):
    got = _rows(reports.customer_history(_sample_orders(spark, lake)))
    assert [(r[0], r[1], r[2]) for r in got] == [
        ("B-16", 1, 139.99), ("B-14", 1, 88.0), ("B-12", 2, 70.2), ("B-11", 2, 44.9), ("B-15", 1, 27.35), ("B-13", 2, 21.0),
    ]
    assert got[3][3:] == (datetime(2023, 11, 3, 7, 5), datetime(2023, 11, 4, 9, 9, 9))


def test_status_breakdown(spark, lake):
    got = set(_rows(reports.status_breakdown(_sample_orders(spark, lake))))
    assert got == {("completed", 5, 55.56), ("pending", 1, 11.11), ("shipped", 2, 22.22), ("cancelled", 1, 11.11)}


def test_event_reports(spark, lake):
    events = batch.clean_rows(spark, lake[0], EVENTS)
    assert _rows(reports.event_distribution(events)) == [
        ("page_view", 4, 3), ("click", 2, 2), ("purchase", 1, 1),
    ]
    assert _rows(reports.traffic(events)) == [("NO", "tv", 2), ("NZ", "watch", 1), ("PT", "tv", 1)]
    assert _rows(reports.funnel(events)) == [(3, 2, 1, 33.33)]
    assert _rows(reports.funnel(events.filter("event_type = 'purchase'"))) == [(0, 0, 1, None)]
    assert {(r["event_id"], r["day"]) for r in events.filter("order_id IS NOT NULL").collect()} == {
        ("E-5", "04"),
    }


def test_unknown_status_is_in_no_revenue(spark):
    df = spark.createDataFrame([(None, 1.0), ("x", 2.0), ("cancelled", 4.0)], "status string, total_amount double")
    assert [r["total_amount"] for r in reports.not_cancelled(df).collect()] == [2.0]


def test_average_leaves_out_missing_amounts(spark):
    rows = [("a", "x", 10.0, "01"), ("b", "x", None, "01"), ("c", "x", None, "02")]
    df = spark.createDataFrame(rows, "customer_id string, status string, total_amount double, day string")
    df = df.selectExpr("*", "'2024' AS year", "'01' AS month")
    got = [(r["total_orders"], r["daily_revenue"], r["avg_order_value"]) for r in reports.daily_revenue(df).collect()]
    assert got == [(2, 10.0, 10.0), (1, None, None)]


def test_sums_do_not_depend_on_order(spark):
    amounts = [0.1, 0.2, -0.3, 1e11, 0.0001, -1e11, 71.33, -0.00004, None]
    exact = sum(Decimal(str(a)).quantize(Decimal("0.0001")) for a in amounts if a is not None)
    for order in (amounts, amounts[::-1], sorted(amounts, key=lambda a: (a is None, a))):
        df = spark.createDataFrame([(a,) for a in order], "a double")
        assert df.agg(exact_sum(F.col("a"), 4)).first()[0] == float(exact)
    column = F.col("a")
    many = spark.range(3_000_000).select((F.col("id") % 1000 / 100 - 3).alias("a"))
    got = many.agg(exact_sum(column, 4), exact_sum(column, 2), exact_sum(column)).first()
    assert got[0] == got[1] == 3000 * (sum(range(1000)) - 300_000) / 100
    assert abs(got[2] - float(got[0])) < 1
    assert df.limit(0).agg(exact_sum(column, 4)).first()[0] is None
    small = spark.range(1_000_000).select(F.lit(0.00004).alias("a")).agg(exact_sum(column), exact_sum(column, 5)).first()
    assert abs(small[0] - 40) < 1e-6 and small[1] == 40.0
    odd = spark.createDataFrame([(1e30,), (1e15,), (0.25,), (None,)], "a double")
    assert odd.agg(exact_sum(column, 6)).first()[0] == 1e30 + 1e15
    assert odd.where("a < 1e20").agg(exact_sum(column, 2)).first()[0] == 1e15 + 0.25
    odd = odd.union(spark.createDataFrame([(float("nan"),)], "a double"))
    assert str(odd.agg(exact_sum(column, 2)).first()[0]) == "nan"


RAW = [("a", "1"), ("a", "1"), ("b", "0"), ("b", None), (None, None), (None, None), (None, "0"), ("c", "x")]


def _run(spark, rows, lake, batch_id="b1", **more):
    df = spark.createDataFrame(rows, "`ID` string, `Qty` string")
    return batch.run_batch(df, ITEMS, str(lake), batch_id, run_ts=datetime(2024, 5, 6, tzinfo=UTC), **more)


def test_every_raw_row_is_accounted_for(spark, tmp_path):
    metrics = _run(spark, RAW, tmp_path)
    assert metrics == {
        "raw_count": 8, "clean_count": 3, "quarantine_count": 2, "duplicate_count": 2, "all_null_count": 1,
        "cast_failure_count": 1, "pass_rate_pct": 37.5, "below_threshold": True,
    }
    good = batch.clean_rows(spark, str(tmp_path), ITEMS)
    assert {(r["id"], r["qty"], r["day"]) for r in good.collect()} == {("a", 1, "06"), ("b", None, "06"), ("c", None, "06")}
    bad = batch.quarantine_rows(spark, str(tmp_path), ITEMS)
    assert {(r["id"], r["_quarantine_reason"]) for r in bad.collect()} == {("b", "non_positive:qty"), (None, "null:id")}


def test_rerun_replaces_and_other_batches_stay(spark, tmp_path):
    _run(spark, RAW, tmp_path, "b1")
    _run(spark, [("z", "9")], tmp_path, "b2")
    _run(spark, RAW[:3], tmp_path, "b1")
    good = batch.clean_rows(spark, str(tmp_path), ITEMS)
    assert sorted((r[BATCH], r["id"]) for r in good.collect()) == [("b1", "a"), ("b2", "z")]
    runs = {r[BATCH]: r["raw_count"] for r in batch.quality_runs(spark, str(tmp_path)).collect()}
    assert runs == {"b1": 3, "b2": 1}


def test_failed_run_is_made_good_by_the_next(spark, tmp_path):
    rows = spark.range(5000).select(
        F.col("id").cast("string").alias("id"),
        F.lit("1").alias("qty"),
        F.concat(F.lit("2024-01-"), F.lpad((F.col("id") % 28 + 1).cast("string"), 2, "0")).alias("date"),
    )
    broken = rows.withColumn("qty", F.when(F.col("id") == "4999", F.raise_error(F.lit("disk gone"))).otherwise("1"))
    lake = str(tmp_path)
    batch.run_batch(rows.filter("id < 10"), ITEMS, lake, "b1")
    with pytest.raises(Exception, match="disk gone"):
        batch.run_batch(broken, ITEMS, lake, "b1")
    assert batch.run_batch(rows, ITEMS, lake, "b1")["clean_count"] == 5000
    assert batch.clean_rows(spark, lake, ITEMS).select("id").distinct().count() == 5000


def test_empty_batch(spark, tmp_path):
    metrics = _run(spark, [], tmp_path)
    assert (metrics["raw_count"], metrics["pass_rate_pct"], metrics["below_threshold"]) == (0, 0.0, True)


def test_strict_batch_needs_its_columns(spark, tmp_path):
    df = spark.createDataFrame([("1",)], "qty string")
    with pytest.raises(ContractError, match="id"):
        batch.run_batch(df, ITEMS, str(tmp_path), "b1", strict=True)


def test_duplicates_within_files_only(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for name in ("one", "two"):
        (tmp_path / "in" / f"{name}.csv").write_text("id,qty\na,1\na,1\n")
    source = batch.Source(str(tmp_path / "in"), "csv", "events")
    options = {"run_ts": datetime(2024, 1, 1, tzinfo=UTC)}
    for per_file, rows in ((False, 1), (True, 2)):
        lake = str(tmp_path / f"lake{rows}")
        summary = batch.run_sources(spark, [source], lake, "b", per_file=per_file, **options).first()
        assert (summary["raw_count"], summary["duplicate_count"]) == (4, 4 - rows)


def test_table_without_contract_passes_through(spark, tmp_path):
    df = spark.createDataFrame([(1, None), (1, None)], "`A Key` int, v string")
    free = Contract("free")
    metrics = batch.run_batch(df, free, str(tmp_path), "b1")
    assert (metrics["clean_count"], metrics["quarantine_count"]) == (1, 0)
    rows = batch.clean_rows(spark, str(tmp_path), free, "`a_key` int, `v` string")
    assert rows.select("a_key", "v").first() == (1, None)


def test_published_folders(spark, lake, tmp_path):
    data, bad = str(tmp_path / "data"), str(tmp_path / "bad")
    for _ in range(2):
        batch.publish_batch(spark, lake[0], ORDERS, "run1", data, bad, "csv")
    folders = ("year", "month", "day", BATCH)
    assert readers.read_partitioned(spark, data, batch.contract_ddl(ORDERS), folders).count() == 10
    assert (tmp_path / "data/year=2023/month=11/day=03/_batch=run1").is_dir()
    assert (tmp_path / "bad/source=csv/year=2024/month=03/day=02/_batch=run1").is_dir()


def test_published_folders_follow_a_smaller_batch(spark, tmp_path):
    lake, data, bad = (str(tmp_path / n) for n in ("lake", "data", "bad"))
    rows = [("a", "1", "2024-05-06"), ("b", "0", "2024-05-06"), ("c", "1", "2024-05-07"), (None, "1", "2024-05-07")]
    for kept in (rows, rows[:1], []):
        df = spark.createDataFrame(kept, "id string, qty string, date string")
        batch.run_batch(df, ITEMS, lake, "b1")
        batch.publish_batch(spark, lake, ITEMS, "b1", data, bad, "csv")
        schema = batch.contract_ddl(ITEMS)
        got = readers.read_partitioned(spark, data, schema, ("year", "month", "day", BATCH)).collect()
        assert sorted(r["id"] for r in got) == [r[0] for r in kept if r[0] and r[1] == "1"]
        got = readers.read_partitioned(spark, bad, schema, ("source", "year", "month", "day", BATCH))
        assert got.count() == sum(r[0] is None or r[1] == "0" for r in kept)


def test_sources_of_one_table_stay_apart(spark, tmp_path):
    for name in ("x", "y"):
        (tmp_path / name).mkdir()
        (tmp_path / name / "orders.csv").write_text(fixtures.orders_csv().replace("G-", f"{name}-"))
    sources = [batch.Source(str(tmp_path / name / "orders.csv"), "csv", "orders") for name in ("x", "y")]
    lake = str(tmp_path / "lake")
    for _ in range(2):
        summary = batch.run_sources(spark, sources, lake, "b1").collect()
    assert [r["raw_count"] for r in summary] == [9, 9] and len({r["source"] for r in summary}) == 2
    assert {r["order_id"][0] for r in batch.clean_rows(spark, lake, ORDERS).collect()} == {"x", "y"}
    with pytest.raises(ValueError, match="names"):
        batch.run_sources(spark, [sources[0], sources[0]], lake, "b2")


@pytest.mark.parametrize("odd", ["a%41b", "a/b", "a b", "a=b", "", "*"])
def test_odd_batch_ids_are_refused(spark, tmp_path, odd):
    with pytest.raises(ValueError, match="batch id"):
        _run(spark, RAW, tmp_path, odd)


def test_sql_on_the_lake(spark, lake, tmp_path):
    database = catalog.ensure_database(spark, "samples_db", str(tmp_path / "db"))
    for contract in (ORDERS, EVENTS, ORDERS):
        batch.register_lake_table(spark, lake[0], contract, database)
    assert spark.table("samples_db.orders").columns == [*ORDERS.columns, "year", "month", "day"]
    assert spark.table("samples_db.orders").count() == 10
    assert spark.table("samples_db.orders_quarantine").count() == 2
    shares = spark.sql(
        "SELECT status, round(100D * count(*) / sum(count(*)) OVER (), 2) AS pct FROM samples_db.orders GROUP BY status"
    )
    assert {r["status"]: r["pct"] for r in shares.collect()}["completed"] == 60.0
    got = spark.sql("SELECT count(DISTINCT user_id) FROM samples_db.events WHERE event_type = 'page_view'").first()
    assert got[0] == 3


def test_new_batches_and_columns_reach_the_tables(spark, tmp_path):
    database = catalog.ensure_database(spark, "growing_db", str(tmp_path / "db"))
    lake = str(tmp_path / "lake")
    _run(spark, [("a", "1")], lake, "b1")
    batch.register_lake_table(spark, lake, ITEMS, database)
    batch.run_batch(spark.createDataFrame([("b", "2", "n")], "id string, qty string, note string"), ITEMS, lake, "b2")
    assert spark.table("growing_db.items").count() == 1
    batch.register_lake_table(spark, lake, ITEMS, database, "`note` string")
    rows = spark.table("growing_db.items").orderBy("id").collect()
    assert [(r["id"], r["qty"], r["note"]) for r in rows] == [("a", 1, None), ("b", 2, "n")]


def test_hot_rows_and_hot_days(spark, tmp_path):
    """A third of the rows are copies of one row, another third fall on one day."""
    n = 30_000
    key = F.col("id")
    raw = spark.range(n).select(
        F.when(key % 3 == 0, "hot").otherwise(key.cast("string")).alias("id"),
        F.lit("1").alias("qty"),
        F.when(key % 3 < 2, "2024-01-01")
        .otherwise(F.concat(F.lit("2024-02-"), F.lpad((key % 28 + 1).cast("string"), 2, "0")))
        .alias("date"),
    )
    metrics = batch.run_batch(raw, ITEMS, str(tmp_path), "b1")
    assert (metrics["raw_count"], metrics["clean_count"]) == (n, n - n // 3 + 1)
    marks = batch.marked_rows(spark, str(tmp_path), ITEMS, "`date` string")
    assert marks.filter("id = 'hot'").select(shape.COPIES).first()[0] == n // 3


def test_command_line(spark, tmp_path, capfd):
    (tmp_path / "orders.csv").write_text(fixtures.orders_csv())
    main([f"orders=csv:{tmp_path}/orders.csv", "--lake", f"{tmp_path}/lake", "--batch", "b1", "--mode", "text"])
    assert batch.clean_rows(spark, f"{tmp_path}/lake", ORDERS).count() == 9
    with pytest.raises(SystemExit):
        main(["orders", "--lake", "x", "--batch", "b1"])
    assert "table=format:path" in capfd.readouterr().err


def _number(text):
    try:
        value = float(text)
    except (TypeError, ValueError):
        return None
    return int(value) if abs(value) < 2**31 else None


def _by_hand(rows):
    """What a batch of (id, qty, date) text rows must come to, row by row."""
    zones = {}
    for row in set(rows):
        key, qty, date = row
        number = _number(qty)
        if row == (None, None, None):
            zone = ("blank", None)
        elif key is None:
            zone = ("quarantine", "null:id")
        elif number is not None and number <= 0:
            zone = ("quarantine", "non_positive:qty")
        else:
            zone = ("clean", None)
        parts = (date[:4], date[5:7], date[8:10]) if date and date[0].isdigit() else (None, None, None)
        failed = int(qty is not None and number is None)
        zones.setdefault((key, number, date, *zone, *parts, rows.count(row), failed), 0)
        zones[(key, number, date, *zone, *parts, rows.count(row), failed)] += 1
    return zones


TEXT_ROW = st.tuples(
    st.sampled_from([None, "a", "b"]),
    st.sampled_from([None, "1", "0", "-3", "2.0", "x", "", "99999999999", " 7 "]),
    st.sampled_from([None, "2024-01-05", "2023-12-31 23:59:59", "soon"]),
)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(TEXT_ROW, min_size=1, max_size=80))
def test_batches_by_hand(spark, rows):
    raw = spark.createDataFrame(rows, "`ID` string, `Qty` string, `Date` string")
    marked = batch.mark_batch(raw, ITEMS)
    shown = marked.select(
        "id", "qty", "date", "_zone", "_quarantine_reason", "year", "month", "day", "_copies", "_cast_failures"
    )
    got = {}
    for row in shown.collect():
        got[tuple(row)] = got.get(tuple(row), 0) + 1
    assert got == _by_hand(rows)
    metrics = batch.zone_metrics(marked).first()
    assert metrics["raw_count"] == len(rows)
    accounted = ("duplicate_count", "all_null_count", "clean_count", "quarantine_count")
    assert sum(metrics[name] for name in accounted) == len(rows)
