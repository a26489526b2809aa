"""Readers, sinks and catalog tables, on files Spark writes from the test tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clearwell.functions.values import DATE_PARTS
from clearwell.operators import quality, shape
from clearwell.plans import reports as plans
from clearwell.sinks import catalog, writers
from clearwell.sources import readers
from clearwell.workloads import shapes
from clearwell.workloads.registry import Tables, query
from clearwell.workloads.shapes import ORDER_TYPES, SQL_DATE_PARTS, STORED_ORDERS

_ORDERS_SQL = f"SELECT {', '.join(ORDER_TYPES)} FROM orders"
# Rows per JSON document, a power of two: a document is read by one task.
_ROWS_PER_DOCUMENT = 8192


def _typed(df: DataFrame) -> DataFrame:
    return shape.apply_contract(df, STORED_ORDERS).select(*ORDER_TYPES)


@query(_ORDERS_SQL)
def parquet_scan(t: Tables) -> DataFrame:
    return readers.read_source(t.spark, f"{t.folder}/orders.parquet", "parquet")


@query(_ORDERS_SQL)
def csv_scan(t: Tables) -> DataFrame:
    path = t.scratch("csv")
    t["orders"].write.option("header", True).csv(path)
    return _typed(readers.read_source(t.spark, path, "csv"))


@query(_ORDERS_SQL)
def csv_text_scan(t: Tables) -> DataFrame:
    """Nothing is read ahead: names are given, types come from the contract."""
    path = t.scratch("csv")
    t["orders"].write.option("header", True).csv(path)
    return _typed(readers.read_source(t.spark, path, "csv", mode="text", columns=tuple(ORDER_TYPES)))


@query(_ORDERS_SQL)
def gzip_csv_scan(t: Tables) -> DataFrame:
    path = t.scratch("csv-gz")
    t["orders"].write.option("header", True).option("compression", "gzip").csv(path)
    only = readers.name_glob("csv")
    return _typed(readers.read_source(t.spark, path, "csv", mode="text", pathGlobFilter=only))


@query(_ORDERS_SQL)
def jsonl_scan(t: Tables) -> DataFrame:
    path = t.scratch("jsonl")
    t["orders"].write.json(path)
    return _typed(readers.read_source(t.spark, path, "jsonl"))


@query(_ORDERS_SQL)
def json_document_scan(t: Tables) -> DataFrame:
    """JSON documents that are arrays of orders; no document has more than a fixed number.

    Rows are numbered within their scan task, so the size of a document does not
    depend on any key.
    """
    path = t.scratch("json")
    orders = t["orders"]
    document = F.floor(F.monotonically_increasing_id() / _ROWS_PER_DOCUMENT)
    body = F.concat(
        F.lit("[\n"),
        F.concat_ws(",\n", F.collect_list(F.to_json(F.struct(*ORDER_TYPES)))),
        F.lit("\n]"),
    )
    documents = orders.withColumn("document", document).groupBy("document").agg(body.alias("body"))
    documents.write.partitionBy("document").text(path)
    return _typed(readers.read_source(t.spark, path, "json", recursiveFileLookup="true"))


_EVENTS_SQL = f"SELECT *, {SQL_DATE_PARTS.format('ts')} FROM events"


def _dated_events(t: Tables) -> DataFrame:
    return shape.add_date_partitions(t["events"], "ts")


def _events_ddl(t: Tables) -> str:
    return readers.ddl(t["events"])


def _read_events(t: Tables, path: str) -> DataFrame:
    return readers.read_partitioned(t.spark, path, _events_ddl(t))


@query(_EVENTS_SQL)
def partitioned_readback(t: Tables) -> DataFrame:
    path = t.scratch("clean")
    writers.write_clean(_dated_events(t), path)
    return _read_events(t, path)


@query(f"""
    SELECT * FROM ({_EVENTS_SQL}) WHERE ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-22'
""")
def date_range_scan(t: Tables) -> DataFrame:
    """Only the folders of the days in question are read."""
    path = t.scratch("clean")
    writers.write_clean(_dated_events(t), path)
    return shape.date_range(_read_events(t, path), "2024-01-05", "2024-01-21")


@query(f"""
    SELECT event_id, ts, user_id, CASE WHEN day(ts) = 7 THEN 'revised' ELSE event_type END AS event_type,
        value, props, year, month, day
    FROM ({_EVENTS_SQL})
""")
def overwrite_rerun(t: Tables) -> DataFrame:
    """A second write of one day replaces that day and nothing else."""
    path = t.scratch("clean")
    events = _dated_events(t)
    writers.write_clean(events, path, mode="overwrite")
    revised = events.filter(F.col("day") == "07").withColumn("event_type", F.lit("revised"))
    writers.write_clean(revised, path, mode="overwrite")
    return _read_events(t, path)


_BAD_EVENTS_SQL = f"""
    SELECT *, 'events' AS source FROM (
        SELECT CASE WHEN event_id % 40 <> 0 THEN event_id END AS event_id,
            CASE WHEN event_id % 60 <> 0 THEN user_id END AS user_id, value, ts,
            CASE WHEN event_id % 40 = 0 THEN 'null:event_id' WHEN event_id % 60 = 0 THEN 'null:user_id'
                 WHEN value <= 0.5 THEN 'non_positive:excess' END AS _quarantine_reason,
            value - 0.5 AS excess, {SQL_DATE_PARTS.format("ts")}
        FROM events)
    WHERE _quarantine_reason IS NOT NULL"""
_BAD_EVENTS_DDL = (
    "`event_id` bigint, `user_id` bigint, `value` double, `excess` double, `ts` timestamp_ntz, `_quarantine_reason` string"
)


def _bad_events(t: Tables) -> DataFrame:
    key = F.col("event_id")
    faulty = _dated_events(t).select(
        F.when(key % 40 != 0, key).alias("event_id"),
        F.when(key % 60 != 0, F.col("user_id")).alias("user_id"),
        "value",
        (F.col("value") - 0.5).alias("excess"),
        "ts",
        *DATE_PARTS,
    )
    return quality.split_quarantine(faulty, ("event_id", "user_id"), ("excess",))[1]


@query(_BAD_EVENTS_SQL)
def quarantine_sink(t: Tables) -> DataFrame:
    path = t.scratch("quarantine")
    writers.write_quarantine(_bad_events(t), path, source="events")
    return readers.read_partitioned(t.spark, path, _BAD_EVENTS_DDL, ("source", *DATE_PARTS))


@query(f"SELECT * EXCLUDE (source) FROM ({_BAD_EVENTS_SQL})")
def quarantine_flat_sink(t: Tables) -> DataFrame:
    path = t.scratch("quarantine")
    writers.write_quarantine(_bad_events(t), path, mode="overwrite", partitioned=False)
    return t.spark.read.parquet(path)


@query("""
    SELECT CAST(o_custkey AS VARCHAR) AS customer_id, count(*) AS total_orders,
        CAST(sum(CAST(o_totalprice AS DECIMAL(18, 2))) AS DOUBLE) AS lifetime_value,
        min(o_orderdate) AS first_order, max(o_orderdate) AS last_order
    FROM orders GROUP BY o_custkey
""")
def stored_report(t: Tables) -> DataFrame:
    path = t.scratch("report")
    writers.write_report(plans.customer_history(shapes.orders(t), digits=2), path=path)
    return t.spark.read.parquet(path)


def _new_table(t: Tables, path: str) -> str:
    database = catalog.database_name("clear-well", "test")
    catalog.ensure_database(t.spark, database, t.scratch("database"))
    table = f"{database}.events_{uuid.uuid4().hex}"
    catalog.register_table(t.spark, table, path, _events_ddl(t))
    return table


@query(_EVENTS_SQL)
def catalog_scan(t: Tables) -> DataFrame:
    """Folders written after the table was made are found by a refresh."""
    path = t.scratch("clean")
    events = _dated_events(t)
    early = F.col("day") < "12"
    writers.write_clean(events.filter(early), path)
    table = _new_table(t, path)
    writers.write_clean(events.filter(~early), path)
    catalog.refresh_table(t.spark, table, catalog.partition_folders(t.spark, path))
    return readers.read_table(t.spark, table)


@query(f"""
    SELECT *, CASE WHEN day >= '12' THEN 'web' END AS channel FROM ({_EVENTS_SQL})
""")
def catalog_new_column(t: Tables) -> DataFrame:
    """A column that newer files have is added to the table, NULL in the older ones."""
    path = t.scratch("clean")
    events = _dated_events(t)
    early = F.col("day") < "12"
    writers.write_clean(events.filter(early), path)
    table = _new_table(t, path)
    newer = events.filter(~early).withColumn("channel", F.lit("web"))
    writers.write_clean(newer, path)
    catalog.add_columns(t.spark, table, newer.dtypes)
    catalog.refresh_table(t.spark, table)
    return readers.read_table(t.spark, table)
