"""The physical plans that matter at scale."""

import re

import pytest
from pyspark.sql import functions as F

from clearwell.contracts import ORDERS
from clearwell.operators import shape
from clearwell.plans import batch, reports
from clearwell.sinks import writers
from clearwell.sources import readers
from clearwell.workloads import REGISTRY, shapes
from clearwell.workloads.registry import Tables

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture
def tables(spark):
    return Tables(spark, FOLDER)


def plan_of(df, capsys):
    df.explain("formatted")
    return capsys.readouterr().out


def exchanges(plan):
    """Operator lines of the tree at the top of a formatted plan."""
    tree = plan.split("\n\n")[0]
    return re.findall(r"\b(Exchange|BroadcastExchange|Window|CartesianProduct|BroadcastNestedLoopJoin)\b", tree)


def test_batch_shuffles_rows_once_before_the_write(tables, capsys):
    plan = plan_of(batch.mark_batch(shapes.messy_orders(tables), ORDERS), capsys)
    assert exchanges(plan) == ["Exchange"]
    assert "partial_count(1)" in plan


def test_filters_and_columns_reach_the_scan(tables, capsys):
    plan = plan_of(reports.daily_revenue(shapes.orders(tables), "F"), capsys)
    assert "PushedFilters: [IsNotNull(o_orderstatus), Not(EqualTo(o_orderstatus,F))]" in plan
    assert re.search(r"ReadSchema: struct<o_custkey:bigint,o_orderstatus:string,o_totalprice:double,o_orderdate:\w+>", plan)


def test_top_products_joins_totals_and_keeps_ten(tables, capsys):
    plan = plan_of(REGISTRY["top_products"].run(tables), capsys)
    assert "TakeOrderedAndProject" in plan
    assert "l_shipdate" not in plan
    tree = plan.split("\n\n")[0]
    left_of_join = tree[tree.index("Join") :]
    assert left_of_join.count("HashAggregate") == 2


def test_status_share_needs_no_window(tables, capsys):
    plan = plan_of(reports.status_breakdown(shapes.orders(tables)), capsys)
    assert "Window" not in plan


# Queries whose result is a scan of what they wrote show no plan of interest.
WRITING = ("batch_", "stream_", "catalog_", "stored_", "partitioned_", "overwrite_", "run_summary", "land_raw")
COMPUTING = [
    name for name in REGISTRY if not name.startswith(WRITING) and not name.endswith(("_scan", "_sink"))
]


@pytest.mark.parametrize("name", COMPUTING)
def test_no_pairs_and_no_single_task_windows(name, tables, capsys):
    plan = plan_of(REGISTRY[name].run(tables), capsys)
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    assert "Window" not in plan
    assert "Python" not in plan


def test_date_range_prunes_folders(spark, tables, tmp_path, capsys):
    path = str(tmp_path / "events")
    events = shape.add_date_partitions(tables["events"], "ts")
    writers.write_clean(events, path)
    stored = readers.read_partitioned(spark, path, readers.ddl(tables["events"]))
    picked = shape.date_range(stored, "2024-01-03", "2024-01-04")
    plan = plan_of(picked, capsys)
    filters = re.search(r"PartitionFilters: \[(.*)\]", plan).group(1)
    assert "year" in filters and "day" in filters
    days = picked.select(F.input_file_name().alias("f")).distinct().collect()
    assert {re.search(r"day=(\d+)", r["f"]).group(1) for r in days} == {"03", "04"}


def test_clean_zone_is_a_partition_filter(spark, tables, tmp_path, capsys):
    batch.run_batch(shapes.messy_orders(tables), ORDERS, str(tmp_path), "b1")
    plan = plan_of(batch.clean_rows(spark, str(tmp_path), ORDERS).select("order_id"), capsys)
    assert re.search(r"PartitionFilters: \[.*_zone.*clean", plan)
    assert "ReadSchema: struct<order_id:string>" in plan


def test_metrics_read_only_the_marks(spark, tables, tmp_path, capsys):
    batch.run_batch(shapes.messy_orders(tables), ORDERS, str(tmp_path), "b1")
    marks = batch.marked_rows(spark, str(tmp_path), ORDERS)
    plan = plan_of(batch.zone_metrics(marks), capsys)
    assert "ReadSchema: struct<_copies:bigint,_cast_failures:int>" in plan


def test_writes_gather_folders_under_aqe(tables, capsys):
    events = shape.add_date_partitions(tables["events"], "ts")
    plan = plan_of(writers.clustered(events, "year", "month", "day"), capsys)
    assert "REBALANCE_PARTITIONS_BY_COL" in plan
    assert exchanges(plan) == ["Exchange"]
