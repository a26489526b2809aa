"""Whole batch and streaming runs on the test tables."""

from __future__ import annotations

import uuid
from datetime import UTC, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clearwell.contracts import EVENTS, ORDERS, Contract
from clearwell.functions.values import DATE_PARTS
from clearwell.operators import quality, routing, shape
from clearwell.plans import batch, reports
from clearwell.sinks import catalog
from clearwell.sinks.writers import BATCH
from clearwell.sources import readers
from clearwell.streaming import ingest
from clearwell.workloads import shapes
from clearwell.workloads.registry import Tables, query
from clearwell.workloads.shapes import MESSY_EXTRAS, SQL_MARKED_ORDERS

_BATCH_ID = "b1"
_DATA = "order_id, customer_id, product_name, quantity, unit_price, total_amount, status, created_at, note"
_DATE = "year, month, day"
_SQL_COUNTS = f"""
    {SQL_MARKED_ORDERS},
    counts AS (
        SELECT
            CAST(sum(copies) AS BIGINT) AS raw_count,
            count(*) FILTER (zone = 'clean') AS clean_count,
            count(*) FILTER (zone = 'quarantine') AS quarantine_count,
            CAST(sum(copies - 1) AS BIGINT) AS duplicate_count,
            count(*) FILTER (zone = 'blank') AS all_null_count,
            CAST(sum(failures) AS BIGINT) AS cast_failure_count
        FROM marked
    ),
    metrics AS (
        SELECT *, round_even(CAST(clean_count AS DOUBLE) / raw_count * 100, 2) AS pass_rate_pct,
            round_even(CAST(clean_count AS DOUBLE) / raw_count * 100, 2) < 80 AS below_threshold
        FROM counts
    )"""


def _run(t: Tables) -> str:
    lake = t.scratch("lake")
    batch.run_batch(shapes.messy_orders(t), ORDERS, lake, _BATCH_ID)
    return lake


def _comparable(df: DataFrame) -> DataFrame:
    """Timestamps without a zone, as the test tables have them."""
    zoned = [name for name, kind in df.dtypes if kind == "timestamp"]
    return df.withColumns({name: F.col(name).cast("timestamp_ntz") for name in zoned}).drop(BATCH)


@query(f"WITH {SQL_MARKED_ORDERS} SELECT {_DATA}, {_DATE} FROM marked WHERE zone = 'clean'")
def batch_clean(t: Tables) -> DataFrame:
    return _comparable(batch.clean_rows(t.spark, _run(t), ORDERS, MESSY_EXTRAS))


@query(f"""
    WITH {SQL_MARKED_ORDERS}
    SELECT {_DATA}, reason AS _quarantine_reason, {_DATE} FROM marked WHERE zone = 'quarantine'
""")
def batch_quarantine(t: Tables) -> DataFrame:
    return _comparable(batch.quarantine_rows(t.spark, _run(t), ORDERS, MESSY_EXTRAS))


@query(f"WITH {_SQL_COUNTS} SELECT * FROM metrics")
def batch_metrics(t: Tables) -> DataFrame:
    """The metrics of a batch straight from its rows, without a write."""
    return quality.zone_metrics(batch.mark_batch(shapes.messy_orders(t), ORDERS))


@query(f"""
    WITH {SQL_MARKED_ORDERS}
    SELECT zone, {_DATA}, reason AS _quarantine_reason, {_DATE} FROM marked WHERE zone <> 'blank'
""")
def batch_rerun(t: Tables) -> DataFrame:
    """A second run of the same batch id replaces the rows of the first."""
    lake = t.scratch("lake")
    raw = shapes.messy_orders(t)
    batch.run_batch(raw.filter(F.col("Status") == "F"), ORDERS, lake, _BATCH_ID)
    batch.run_batch(raw, ORDERS, lake, _BATCH_ID)
    good = batch.clean_rows(t.spark, lake, ORDERS, MESSY_EXTRAS).withColumn("zone", F.lit("clean"))
    bad = batch.quarantine_rows(t.spark, lake, ORDERS, MESSY_EXTRAS).withColumn("zone", F.lit("quarantine"))
    return _comparable(shape.union_by_name(good, bad))


@query(f"""
    WITH {SQL_MARKED_ORDERS}
    SELECT CAST(NULL AS VARCHAR) AS source, {_DATA}, CAST(NULL AS VARCHAR) AS _quarantine_reason, {_DATE}
    FROM marked WHERE zone = 'clean'
    UNION ALL
    SELECT 'csv', {_DATA}, reason, {_DATE} FROM marked WHERE zone = 'quarantine'
""")
def batch_published(t: Tables) -> DataFrame:
    """Clean and quarantine folders apart, the latter by source; the second call changes nothing."""
    lake, data, bad = _run(t), t.scratch("data"), t.scratch("quarantine")
    for _ in range(2):
        batch.publish_batch(t.spark, lake, ORDERS, _BATCH_ID, data, bad, "csv", MESSY_EXTRAS)
    schema = batch.contract_ddl(ORDERS, MESSY_EXTRAS)
    clean = readers.read_partitioned(t.spark, data, schema, (*DATE_PARTS, BATCH))
    quarantine = readers.read_partitioned(
        t.spark, bad, f"{schema}, `{quality.REASON}` string", ("source", *DATE_PARTS, BATCH)
    )
    return _comparable(shape.union_by_name(clean, quarantine))


_REVENUE_SQL = """
    SELECT year, month, day, CAST(sum(CAST(total_amount AS DECIMAL(18, 2))) AS DOUBLE) AS revenue
    FROM {orders} WHERE status <> 'F' GROUP BY year, month, day
"""


@query(f"""
    WITH {SQL_MARKED_ORDERS}, good AS (SELECT * FROM marked WHERE zone = 'clean') {_REVENUE_SQL.format(orders="good")}
""")
def sql_report(t: Tables) -> DataFrame:
    """A report as SQL text on the catalog view of the clean rows."""
    database = catalog.database_name("clear-well", uuid.uuid4().hex)
    catalog.ensure_database(t.spark, database, t.scratch("database"))
    batch.register_lake_table(t.spark, _run(t), ORDERS, database, MESSY_EXTRAS)
    return t.spark.sql(_REVENUE_SQL.format(orders=f"{database}.orders"))


@query(f"""
    WITH {SQL_MARKED_ORDERS}
    SELECT {_DATE}, count(*) AS total_orders,
        CAST(sum(CAST(total_amount AS DECIMAL(18, 2))) AS DOUBLE) AS daily_revenue,
        CAST(sum(CAST(total_amount AS DECIMAL(18, 2))) AS DOUBLE) / count(total_amount) AS avg_order_value,
        count(DISTINCT customer_id) AS unique_customers
    FROM marked WHERE zone = 'clean' AND status <> 'F' GROUP BY {_DATE}
""")
def batch_daily_revenue(t: Tables) -> DataFrame:
    """From a careless upload to the revenue report: raw rows, batch, clean table, report."""
    return reports.daily_revenue(batch.clean_rows(t.spark, _run(t), ORDERS, MESSY_EXTRAS), "F", digits=2)


def _raw_events(t: Tables) -> DataFrame:
    return shapes.events(t).drop("year", "month", "day").withColumn("timestamp", F.col("timestamp").cast("string"))


@query(f"""
    WITH {_SQL_COUNTS}
    SELECT 'orders' AS table_name, * FROM metrics
    UNION ALL
    SELECT 'events', count(*), count(*), 0, 0, 0, 0, 100, false FROM events
""")
def run_summary(t: Tables) -> DataFrame:
    """A line per source after a run over a CSV and a JSON-Lines source."""
    lake, orders, events = t.scratch("lake"), t.scratch("orders"), t.scratch("events")
    # CSV readers cannot see a line without any value, so empty rows come as a second frame.
    raw = shapes.messy_orders(t)
    empty = shape.all_null(raw.columns)
    raw.filter(~empty).write.option("header", True).csv(orders)
    _raw_events(t).write.json(events)
    sources = [
        batch.Source(orders, "csv", "orders", more=raw.filter(empty)),
        batch.Source(events, "jsonl", "events"),
    ]
    summary = batch.run_sources(t.spark, sources, lake, _BATCH_ID, mode="text")
    return summary.withColumnRenamed("table", "table_name").drop(BATCH, "source")


_EVENT_COLUMNS = ("event_id", "user_id", "event_type", "session_id", "device", "country", "timestamp")


@query(f"""
    WITH e AS ({shapes.SQL_EVENTS})
    SELECT event_id, user_id, event_type, CAST(NULL AS VARCHAR) AS page, session_id, device, country,
        ts AS timestamp, CAST(NULL AS VARCHAR) AS order_id, {shapes.SQL_DATE_PARTS.format("ts")}
    FROM e
""")
def stream_ingest(t: Tables) -> DataFrame:
    """Files that land between two calls are taken by the second; none is taken twice."""
    landing, lake, checkpoint = t.scratch("landing"), t.scratch("lake"), t.scratch("checkpoint")
    events = _raw_events(t)
    early = F.col("timestamp") < "2024-01-12"

    def take() -> None:
        schema = readers.text_schema(_EVENT_COLUMNS)
        ingest.ingest_available(t.spark, landing, "jsonl", schema, EVENTS, lake, checkpoint)

    events.filter(early).write.mode("append").json(landing)
    take()
    take()
    events.filter(~early).write.mode("append").json(landing)
    take()
    return _comparable(batch.clean_rows(t.spark, lake, EVENTS))


_STORED_EVENTS = Contract("stored_events", columns={"ts": "timestamp_ntz", "event_id": "bigint"}, date_column="ts")


@query(f"SELECT *, {shapes.SQL_DATE_PARTS.format('ts')} FROM events")
def stream_parquet_ingest(t: Tables) -> DataFrame:
    lake, checkpoint = t.scratch("lake"), t.scratch("checkpoint")
    schema = t["events"].schema
    # A glob, because a stream does not start on the path of a single file.
    path = f"{t.folder}/events.parque[t]"
    ingest.ingest_available(t.spark, path, "parquet", schema, _STORED_EVENTS, lake, checkpoint, per_file=False)
    extras = readers.ddl(t["events"], without=("ts", "event_id"))
    return batch.clean_rows(t.spark, lake, _STORED_EVENTS, extras).drop(BATCH)


@query("SELECT event_id, ts, user_id, event_type FROM events")
def stream_dedup(t: Tables) -> DataFrame:
    """Every event lands twice, in different files; the delay covers the whole period."""
    landing, out, checkpoint = t.scratch("landing"), t.scratch("events"), t.scratch("checkpoint")
    events = t["events"].select("event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type")
    events.write.parquet(landing)
    events.write.mode("append").parquet(landing)
    stream = readers.stream_source(t.spark, landing, "parquet", events.schema)
    fresh = ingest.deduplicate_stream(stream, ("event_id",), "ts", "90 days")
    ingest.append_available(fresh, out, checkpoint, ("event_type",))
    schema = "`event_id` bigint, `ts` timestamp, `user_id` bigint"
    return _comparable(readers.read_partitioned(t.spark, out, schema, (BATCH, "event_type")))


@query("""
    SELECT CAST(o_orderkey AS VARCHAR) AS order_id, CAST(o_custkey AS VARCHAR) AS customer_id,
        o_orderstatus AS status, 'csv' AS format
    FROM orders
""")
def land_raw(t: Tables) -> DataFrame:
    """Gzipped CSV uploads become Parquet in the raw zone, rows as they came."""
    landing, raw, checkpoint = t.scratch("landing"), t.scratch("raw"), t.scratch("checkpoint")
    upload = shapes.orders(t).select("order_id", "customer_id", "status")
    upload.write.option("header", True).option("compression", "gzip").csv(landing)
    schema = readers.text_schema(upload.columns)
    ingest.land_raw(
        t.spark, landing, "csv", schema, raw, checkpoint, pathGlobFilter=readers.name_glob("csv")
    )
    landed = readers.read_partitioned(t.spark, raw, schema, (BATCH, "format", "year", "month", "day"))
    return landed.select(*upload.columns, "format")


@query(f"""
    WITH {_SQL_COUNTS}
    SELECT source, raw_count, clean_count, quarantine_count FROM metrics, (VALUES ('one'), ('two')) s(source)
    UNION ALL SELECT 'rows', count(*) * 2, 0, 0 FROM marked WHERE zone = 'clean'
""")
def two_sources_one_table(t: Tables) -> DataFrame:
    """Two sources of one batch and table: the rows of both stay, each has a line in the summary."""
    lake = t.scratch("lake")
    sources, empty = [], shape.all_null(shapes.messy_orders(t).columns)
    for name in ("one", "two"):
        path = t.scratch(name)
        raw = shapes.messy_orders(t)
        raw.filter(~empty).write.option("header", True).csv(path)
        sources.append(batch.Source(path, "csv", "orders", more=raw.filter(empty), name=name))
    lines = batch.run_sources(t.spark, sources, lake, _BATCH_ID, mode="text")
    lines = lines.select("source", "raw_count", "clean_count", "quarantine_count")
    zero = F.lit(0).cast("bigint")
    rows = batch.clean_rows(t.spark, lake, ORDERS).agg(F.count(F.lit(1)).alias("raw_count"))
    rows = rows.select(F.lit("rows").alias("source"), "raw_count", zero.alias("clean_count"), zero.alias("quarantine_count"))
    return lines.unionByName(rows)


@query("""
    SELECT landing, event_id FROM (VALUES ('one'), ('two')) l(landing), (SELECT CAST(event_id AS VARCHAR) AS event_id FROM events)
""")
def two_landing_folders(t: Tables) -> DataFrame:
    """Two folders, each with a checkpoint of its own, fill one table."""
    lake = t.scratch("lake")
    events = _raw_events(t)
    for name in ("one", "two"):
        landing, checkpoint = t.scratch(name), t.scratch("checkpoint")
        events.withColumn("page", F.lit(name)).write.json(landing)
        schema = readers.text_schema((*_EVENT_COLUMNS, "page"))
        ingest.ingest_available(t.spark, landing, "jsonl", schema, EVENTS, lake, checkpoint)
    return batch.clean_rows(t.spark, lake, EVENTS).select(F.col("page").alias("landing"), "event_id")


@query("""
    SELECT CASE WHEN event_id % 10 = 0 THEN 'corrupt_record' ELSE 'clean' END AS zone, count(*) AS rows
    FROM events GROUP BY 1
    UNION ALL SELECT 'raw_count', count(*) FROM events
""")
def corrupt_records(t: Tables) -> DataFrame:
    """Every tenth line of a JSON-Lines stream does not parse: none is lost, its text is kept."""
    landing, lake, checkpoint = t.scratch("landing"), t.scratch("lake"), t.scratch("checkpoint")
    key = F.col("event_id").cast("bigint")
    line = F.when(key % 10 == 0, F.concat(F.lit("{oops "), "event_id")).otherwise(F.to_json(F.struct(*_EVENT_COLUMNS)))
    _raw_events(t).select(line.alias("value")).write.text(landing)
    schema = readers.text_schema(_EVENT_COLUMNS)
    ingest.ingest_available(t.spark, landing, "jsonl", schema, EVENTS, lake, checkpoint, pathGlobFilter="*.txt")
    clean = batch.clean_rows(t.spark, lake, EVENTS).select(F.lit("clean").alias("zone"))
    bad = batch.quarantine_rows(t.spark, lake, EVENTS, f"`{readers.CORRUPT}` string")
    kept = bad.where(F.col(readers.CORRUPT).startswith("{oops ")).select(F.col(quality.REASON).alias("zone"))
    counted = clean.unionByName(kept).groupBy("zone").agg(F.count(F.lit(1)).alias("rows"))
    raw = batch.quality_runs(t.spark, lake).agg(F.sum("raw_count").alias("rows"))
    return counted.unionByName(raw.select(F.lit("raw_count").alias("zone"), "rows"))


@query(f"""
    WITH {SQL_MARKED_ORDERS}
    SELECT CAST(NULL AS VARCHAR) AS source, {_DATA}, CAST(NULL AS VARCHAR) AS _quarantine_reason, {_DATE}
    FROM marked WHERE zone = 'clean' AND status = 'F'
    UNION ALL
    SELECT 'csv', {_DATA}, reason, {_DATE} FROM marked WHERE zone = 'quarantine' AND status = 'F'
""")
def republish_smaller_batch(t: Tables) -> DataFrame:
    """A batch that has fewer rows when it is published again leaves nothing of the first time."""
    lake, data, bad = t.scratch("lake"), t.scratch("data"), t.scratch("quarantine")
    raw = shapes.messy_orders(t)
    for rows in (raw, raw.filter(F.col("Status") == "F")):
        batch.run_batch(rows, ORDERS, lake, _BATCH_ID)
        batch.publish_batch(t.spark, lake, ORDERS, _BATCH_ID, data, bad, "csv", MESSY_EXTRAS)
    schema = batch.contract_ddl(ORDERS, MESSY_EXTRAS)
    clean = readers.read_partitioned(t.spark, data, schema, (*DATE_PARTS, BATCH))
    folders = ("source", *DATE_PARTS, BATCH)
    quarantine = readers.read_partitioned(t.spark, bad, f"{schema}, `{quality.REASON}` string", folders)
    return _comparable(shape.union_by_name(clean, quarantine))


@query("""
    SELECT event_type, count(DISTINCT event_id) FILTER (event_id % 8 <> 0) AS known,
        2 * count(*) FILTER (event_id % 8 = 0) AS unknown
    FROM events GROUP BY event_type
""")
def stream_dedup_nulls(t: Tables) -> DataFrame:
    """Every event lands twice; those without an id repeat nothing and all stay."""
    landing, out, checkpoint = t.scratch("landing"), t.scratch("events"), t.scratch("checkpoint")
    key = F.when(F.col("event_id") % 8 != 0, F.col("event_id")).alias("event_id")
    events = t["events"].select(key, F.col("ts").cast("timestamp").alias("ts"), "event_type")
    events.write.parquet(landing)
    events.write.mode("append").parquet(landing)
    stream = readers.stream_source(t.spark, landing, "parquet", events.schema)
    ingest.append_available(ingest.deduplicate_stream(stream, ("event_id",), "ts", "90 days"), out, checkpoint, ("event_type",))
    rows = readers.read_partitioned(t.spark, out, "`event_id` bigint, `ts` timestamp", (BATCH, "event_type"))
    unknown = F.count_if(F.col("event_id").isNull()).alias("unknown")
    return rows.groupBy("event_type").agg(F.count("event_id").alias("known"), unknown)


@query("""
    SELECT 'csv' AS format, '2024' AS year, '03' AS month, '05' AS day, count(*) AS rows, count(DISTINCT o_orderkey) AS keys
    FROM orders
    UNION ALL SELECT 'parquet', '2024', '03', '05', count(*), count(DISTINCT event_id) FROM events
""")
def routed_landing(t: Tables) -> DataFrame:
    """Uploads are judged, and the rows of the accepted ones land where the verdicts say; text files do not."""
    uploads, raw = t.scratch("uploads"), t.scratch("raw")
    shapes.orders(t).select("order_id", "status").write.option("header", True).csv(f"{uploads}/a")
    t["events"].select("event_id", "event_type").write.parquet(f"{uploads}/b")
    t["orders"].select(F.col("o_orderpriority").alias("value")).write.text(f"{uploads}/c")
    listed = readers.list_uploads(t.spark, uploads).select("original_key", "size")
    verdicts = routing.route(listed, datetime(2024, 3, 5, tzinfo=UTC), "run-1")
    for _ in range(2):
        ingest.land_accepted(t.spark, verdicts, raw, "run-1")
    parts = []
    for kind, ddl, key in (("csv", "order_id string, status string", "order_id"), ("parquet", "event_id bigint", "event_id")):
        reader = t.spark.read.schema(f"{ddl}, year string, month string, day string").option("header", True)
        rows = reader.format(kind).load(f"{raw}/raw/{kind}")
        parts.append(rows.select(F.lit(kind).alias("format"), "year", "month", "day", F.col(key).cast("string").alias("key")))
    counts = (F.count(F.lit(1)).alias("rows"), F.count_distinct("key").alias("keys"))
    return parts[0].union(parts[1]).groupBy("format", "year", "month", "day").agg(*counts)
