"""Uploads that are odd, repeated, late or of another shape, made from the test tables."""

from __future__ import annotations

from datetime import UTC, datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clearwell.contracts import EVENTS, ORDERS, Contract
from clearwell.functions.values import DATE_PARTS
from clearwell.operators import quality, routing
from clearwell.plans import batch
from clearwell.session import hadoop_path
from clearwell.sinks.manifest import published_rows
from clearwell.sinks.writers import BATCH
from clearwell.sources import ledger, readers
from clearwell.streaming import distinct, ingest
from clearwell.workloads import shapes
from clearwell.workloads.registry import Tables, query

_COLUMNS = ("order_id", "customer_id", "quantity", "total_amount", "status", "created_at")


def _uploads(t: Tables) -> DataFrame:
    """Orders as text, the way an upload has them."""
    orders = t["orders"]
    return orders.select(
        F.col("o_orderkey").cast("string").alias("order_id"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        (F.col("o_orderkey") % 50 + 1).cast("string").alias("quantity"),
        F.lit("10.5").alias("total_amount"),
        F.col("o_orderstatus").alias("status"),
        # The first of the month: folders by the dozen, not by the thousand.
        F.date_format("o_orderdate", "yyyy-MM-01").alias("created_at"),
    )


def _part(t: Tables, remainder: int) -> DataFrame:
    """One of three uploads of all orders."""
    return _uploads(t).where(F.col("order_id").cast("bigint") % 3 == remainder)


_KEY = "CAST(o_orderkey AS VARCHAR) AS order_id"


@query(f"""
    SELECT {_KEY}, CASE o_orderkey % 3 WHEN 1 THEN 'n' || o_orderkey END AS note,
        CASE o_orderkey % 3 WHEN 2 THEN o_orderkey % 7 END AS rank
    FROM orders
""")
def extras_kept(t: Tables) -> DataFrame:
    """Three batches, each with columns of its own beyond the contract; nobody lists them."""
    lake = t.scratch("lake")
    key = F.col("order_id").cast("bigint")
    parts = (
        _part(t, 0),
        _part(t, 1).withColumn("Note", F.concat(F.lit("n"), "order_id")),
        _part(t, 2).withColumn("rank", key % 7),
    )
    for n, part in enumerate(parts):
        batch.run_batch(part, ORDERS, lake, f"b{n}")
    return batch.clean_rows(t.spark, lake, ORDERS).select("order_id", "note", "rank")


@query(f"""
    SELECT {_KEY}, CASE o_orderkey % 3 WHEN 0 THEN CAST(o_orderkey % 7 AS VARCHAR) WHEN 1 THEN 'n' || o_orderkey
        ELSE '{{"code":' || o_orderkey % 5 || '}}' END AS note
    FROM orders
""")
def extras_type_drift(t: Tables) -> DataFrame:
    """A column that is a number in one batch, text in the next and an object in the third reads as text."""
    lake = t.scratch("lake")
    key = F.col("order_id").cast("bigint")
    notes = (key % 7, F.concat(F.lit("n"), "order_id"), F.struct((key % 5).alias("code")))
    for n, note in enumerate(notes):
        batch.run_batch(_part(t, n).withColumn("note", note), ORDERS, lake, f"b{n}")
    return batch.clean_rows(t.spark, lake, ORDERS).select("order_id", "note")


@query(f"""
    SELECT p_partkey, p_name, CAST(NULL AS VARCHAR) AS s_name, 'parts' AS kind FROM part
    UNION ALL SELECT NULL, NULL, s_name, 'suppliers' FROM supplier
""")
def table_without_contract(t: Tables) -> DataFrame:
    """A table that no contract describes has the columns its batches brought."""
    lake, free = t.scratch("lake"), Contract("things")
    batch.run_batch(t["part"].select("p_partkey", "p_name").withColumn("kind", F.lit("parts")), free, lake, "b1")
    batch.run_batch(t["supplier"].select("s_name").withColumn("kind", F.lit("suppliers")), free, lake, "b2")
    return batch.clean_rows(t.spark, lake, free).select("p_partkey", "p_name", "s_name", "kind")


def _two_tables(t: Tables, lake: str) -> tuple[Contract, Contract]:
    """Orders and their customers; every tenth order and every fiftieth customer breaks a rule."""
    people = Contract("people", {"customer_id": "string", "balance": "double"}, ("customer_id",), ("balance",))
    raw = _uploads(t).withColumn("quantity", F.when(F.col("order_id").cast("bigint") % 10 != 0, F.col("quantity")).otherwise("0"))
    batch.run_batch(raw, ORDERS, lake, "b1")
    customers = t["customer"].select(
        F.when(F.col("c_custkey") % 50 != 0, F.col("c_custkey").cast("string")).alias("customer_id"),
        F.col("c_custkey").cast("double").alias("balance"),
        F.lit("2024-02-03").alias("date"),
    )
    batch.run_batch(customers, people, lake, "b1")
    return ORDERS, people


@query("""
    SELECT 'csv' AS source, 'non_positive:quantity' AS reason, count(*) AS rows FROM orders WHERE o_orderkey % 10 = 0
    UNION ALL SELECT source, 'null:customer_id', count(DISTINCT c_custkey) FROM customer, (VALUES ('csv'), ('json')) s(source)
    WHERE c_custkey % 50 = 0 GROUP BY source
""")
def two_tables_one_quarantine(t: Tables) -> DataFrame:
    """Two tables publish a batch of one id below one quarantine folder, twice, one of them under two sources."""
    lake, data, bad = t.scratch("lake"), t.scratch("data"), t.scratch("quarantine")
    orders, people = _two_tables(t, lake)
    for _ in range(2):
        batch.publish_batch(t.spark, lake, orders, "b1", f"{data}/orders", bad, "csv")
        for source in ("csv", "json"):
            batch.publish_batch(t.spark, lake, people, "b1", f"{data}/people-{source}", bad, source)
    rows = readers.read_partitioned(t.spark, bad, f"`{quality.REASON}` string", ("source", *DATE_PARTS, BATCH))
    return rows.groupBy("source", F.col(quality.REASON).alias("reason")).agg(F.count(F.lit(1)).alias("rows"))


@query(f"""
    SELECT 'after' AS moment, {_KEY} FROM orders WHERE o_orderkey % 3 = 1
    UNION ALL SELECT 'mended', CAST(o_orderkey AS VARCHAR) FROM orders WHERE o_orderkey % 3 = 1
""")
def published_after_crash(t: Tables) -> DataFrame:
    """A publication that ends before old folders go: readers of the manifest see the new rows, the next one tidies up."""
    lake, data, bad = t.scratch("lake"), t.scratch("data"), t.scratch("quarantine")
    schema, folders = batch.contract_ddl(ORDERS), (*DATE_PARTS, BATCH)
    batch.run_batch(_uploads(t), ORDERS, lake, "b1")
    batch.publish_batch(t.spark, lake, ORDERS, "b1", data, bad, "csv")
    batch.run_batch(_part(t, 1), ORDERS, lake, "b1")
    kept, batch._clear = batch._clear, lambda *_: None
    try:
        batch.publish_batch(t.spark, lake, ORDERS, "b1", data, bad, "csv")
    finally:
        batch._clear = kept
    seen = published_rows(t.spark, data, schema, folders).select(F.lit("after").alias("moment"), "order_id")
    seen.write.parquet(after := t.scratch("after"))
    batch.publish_batch(t.spark, lake, ORDERS, "b1", data, bad, "csv")
    mended = readers.read_partitioned(t.spark, data, schema, folders).select(F.lit("mended").alias("moment"), "order_id")
    return t.spark.read.parquet(after).union(mended)


def _csv(df: DataFrame, folder: str) -> None:
    df.coalesce(1).write.mode("append").option("header", True).csv(folder)


@query(f"""
    SELECT 'clean' AS kind, {_KEY}, CASE WHEN o_orderkey % 3 = 1 THEN 'web' END AS channel FROM orders
    UNION ALL SELECT 'set apart', CAST(count(*) AS VARCHAR), NULL FROM (VALUES (1), (2)) v(x)
""")
def odd_file_in_feed(t: Tables) -> DataFrame:
    """Three CSV shapes, a file that is no gzip file and one without a header in one folder; then a good file more."""
    landing, lake, checkpoint = t.scratch("landing"), t.scratch("lake"), t.scratch("checkpoint")
    _csv(_part(t, 0), landing)
    _csv(_part(t, 1).withColumn("channel", F.lit("web")).select("channel", *_COLUMNS), landing)
    for name, text in (("odd.csv.gz", "this is no gzip file"), ("empty.csv", "\n\n")):
        files, path = hadoop_path(t.spark, f"{landing}/{name}")
        out = files.create(path, True)
        out.write(bytearray(text, "utf-8"))
        out.close()

    def take() -> None:
        schema = readers.text_schema(_COLUMNS)
        ingest.ingest_available(
            t.spark, landing, "csv", schema, ORDERS, lake, checkpoint, pathGlobFilter=readers.name_glob("csv")
        )

    take()
    _csv(_part(t, 2).select(*reversed(_COLUMNS)), landing)
    take()
    rows = batch.clean_rows(t.spark, lake, ORDERS).select(F.lit("clean").alias("kind"), "order_id", "channel")
    apart = ledger.unreadable_files(t.spark, lake).agg(F.count(F.lit(1)).cast("string").alias("order_id"))
    return rows.union(apart.select(F.lit("set apart").alias("kind"), "order_id", F.lit(None).cast("string")))


_SURPLUS_SQL = """
    SELECT kind, zone, count(*) AS rows, count(*) FILTER (zone = 'corrupt_record') AS texts FROM (
        SELECT CASE WHEN o_orderkey % 4 = 0 THEN 'corrupt_record' ELSE 'clean' END AS zone FROM orders), {kinds} GROUP BY kind, zone"""


@query(_SURPLUS_SQL.format(kinds="(VALUES ('stream'), ('batch')) k(kind)"))
def csv_surplus_fields(t: Tables) -> DataFrame:
    """Every fourth CSV line has two values too many, others lack the last one: none is lost, in streams and batches."""
    landing, checkpoint = t.scratch("landing"), t.scratch("checkpoint")
    key = F.col("order_id").cast("bigint")
    line = F.concat_ws(",", *_COLUMNS)
    short = F.concat_ws(",", *_COLUMNS[:-1])
    body = F.when(key % 4 == 0, F.concat(line, F.lit(',"extra, quoted",more'))).when(key % 4 == 1, short).otherwise(line)
    header = t.spark.range(1).select(F.lit(",".join(_COLUMNS)).alias("value"))
    # A text file of several parts would have its header in the first one only.
    rows = _uploads(t).select(body.alias("value"))
    header.union(rows).coalesce(1).write.text(landing)
    only = {"pathGlobFilter": "*.txt"}
    lakes = {"stream": t.scratch("lake"), "batch": t.scratch("lake")}
    schema = readers.text_schema(_COLUMNS)
    ingest.ingest_available(t.spark, landing, "csv", schema, ORDERS, lakes["stream"], checkpoint, **only)
    batch.run_sources(t.spark, [batch.Source(landing, "csv", "orders", options=only)], lakes["batch"], "b1", "text")
    parts = []
    for kind, lake in lakes.items():
        clean = batch.clean_rows(t.spark, lake, ORDERS).select(F.lit("clean").alias("zone"), F.lit(0).alias("text"))
        bad = batch.quarantine_rows(t.spark, lake, ORDERS)
        told = F.col(readers.CORRUPT).endswith(',"extra, quoted",more').cast("int")
        bad = bad.select(F.col(quality.REASON).alias("zone"), told.alias("text"))
        both = clean.union(bad).groupBy("zone").agg(F.count(F.lit(1)).alias("rows"), F.sum("text").alias("texts"))
        parts.append(both.select(F.lit(kind).alias("kind"), "*"))
    return parts[0].union(parts[1])


@query("""
    SELECT 'corrupt' AS kind, count(*) AS rows FROM part
    UNION ALL SELECT 'document', count(*) FROM (VALUES (1)) v(x)
    UNION ALL SELECT 'orders', count(*) FROM orders
""")
def all_corrupt_source(t: Tables) -> DataFrame:
    """A JSON-Lines source and a JSON document in which nothing parses hold up no source after them."""
    lake, lines, document, good = t.scratch("lake"), t.scratch("lines"), t.scratch("document"), t.scratch("good")
    t["part"].select(F.concat(F.lit("{oops "), F.col("p_partkey").cast("string")).alias("value")).write.text(lines)
    t["part"].limit(1).select(F.lit("[1, 2").alias("value")).coalesce(1).write.text(document)
    _csv(_uploads(t), good)
    sources = [
        batch.Source(lines, "jsonl", "events", name="lines"),
        batch.Source(document, "json", "events", name="document"),
        batch.Source(good, "csv", "orders"),
    ]
    batch.run_sources(t.spark, sources, lake, "b1")
    bad = batch.quarantine_rows(t.spark, lake, EVENTS).where(F.col(quality.REASON) == "corrupt_record")
    kind = F.when(F.col(readers.CORRUPT).startswith("{oops "), "corrupt").otherwise("document").alias("kind")
    count = F.count(F.lit(1)).alias("rows")
    orders = batch.clean_rows(t.spark, lake, ORDERS).agg(count).select(F.lit("orders").alias("kind"), "rows")
    return bad.groupBy(kind).agg(count).union(orders)


@query(f"""
    SELECT {_KEY}, count(*) AS copies FROM orders GROUP BY o_orderkey
    UNION ALL SELECT 'files', count(*) FROM (VALUES (1), (2), (3)) v(x)
""")
def renewed_checkpoint(t: Tables) -> DataFrame:
    """The checkpoint is lost twice: files taken before are known, only the new one is taken."""
    landing, lake = t.scratch("landing"), t.scratch("lake")
    for parts in ((0, 1), (), (2,)):
        for part in parts:
            _csv(_part(t, part), landing)
        schema, checkpoint = readers.text_schema(_COLUMNS), t.scratch("checkpoint")
        ingest.ingest_available(t.spark, landing, "csv", schema, ORDERS, lake, checkpoint)
    count = F.count(F.lit(1)).alias("copies")
    rows = batch.clean_rows(t.spark, lake, ORDERS).groupBy("order_id").agg(count)
    return rows.union(ledger.taken_files(t.spark, lake).agg(count).select(F.lit("files").alias("order_id"), "copies"))


# Names that a decoder of keys, a splitter of folders or a pattern would take for something else.
_NAMES = ("plain.csv", "a+b.csv", "k=v.csv", "50%25 off.csv", "{x}[y]*.csv")


@query("""
    SELECT CASE n WHEN 5 THEN 'plain-' ELSE split_part(name, '.', 1) END AS name, count(*) + 1 AS lines, TRUE AS same
    FROM orders, (VALUES (0, 'plain.csv'), (1, 'a+b.csv'), (2, 'k=v.csv'), (3, '50%25 off.csv'), (4, '{x}[y]*.csv'),
        (5, 'other/plain.csv')) v(n, name)
    WHERE o_orderkey % 6 = n GROUP BY n, name
""")
def routed_landing_names(t: Tables) -> DataFrame:
    """Accepted uploads of odd names and of two shapes land whole, two of one name side by side; a second run adds none."""
    uploads, raw = t.scratch("uploads"), t.scratch("raw")
    for n, name in enumerate((*_NAMES, "other/plain.csv")):
        rows = _uploads(t).where(F.col("order_id").cast("bigint") % 6 == n)
        rows = rows.select("status", "order_id") if n % 2 else rows
        _csv(rows, part := t.scratch("part"))
        files, target = hadoop_path(t.spark, f"{uploads}/{name}")
        files.mkdirs(target.getParent())
        _, folder = hadoop_path(t.spark, part)
        (only,) = [f.getPath() for f in files.listStatus(folder) if f.getPath().getName().endswith(".csv")]
        files.rename(only, target)
    listed = readers.list_uploads(t.spark, uploads).select("original_key", "size")
    verdicts = routing.route(listed, datetime(2024, 3, 5, tzinfo=UTC), "run-1")
    for _ in range(2):
        report = ingest.land_accepted(t.spark, verdicts, raw, "run-1")
    whole = t.spark.read.format("binaryFile").option("recursiveFileLookup", True)
    before = whole.load(uploads).select(F.col("path").alias("original_key"), F.sha2("content", 256).alias("was"))
    content = F.col("content").cast("string")
    after = whole.option("pathGlobFilter", "*.csv").load(f"{raw}/raw/csv/year=2024/month=03/day=05").select(
        F.regexp_extract("path", "([^/]+)$", 1).alias("file"),
        F.sha2("content", 256).alias("sha"),
        (F.size(F.split(content, "\n")) - 1).cast("bigint").alias("lines"),
    )
    report = report.withColumn("file", F.regexp_extract("landed_path", "([^/]+)$", 1))
    name = F.regexp_replace("file", r"(?:([^-])|-[0-9A-F]{8})[.]csv$", "$1")
    name = F.when(F.col("file").rlike("-[0-9A-F]{8}[.]csv$"), F.concat(name, F.lit("-"))).otherwise(name)
    joined = after.join(report, "file", "full").join(before, "original_key", "full")
    return joined.select(name.alias("name"), "lines", F.coalesce(F.col("sha") == F.col("was"), F.lit(False)).alias("same"))


_MIDDLE = "TIMESTAMP '2024-01-15 12:00:00'"


@query(f"""
    SELECT CAST(event_id AS VARCHAR) AS event_id, CASE WHEN ts < {_MIDDLE} AND ts < latest - INTERVAL 1 HOUR THEN 'late'
        ELSE 'in_time' END AS kind, 1 AS rows
    FROM events, (SELECT max(ts) AS latest FROM events WHERE ts >= {_MIDDLE}) l
    UNION ALL SELECT 'all', 'duplicate', 2 * count(*) FILTER (ts >= {_MIDDLE}) + count(*) FILTER (ts < {_MIDDLE}) FROM events
""")
def stream_late_rows(t: Tables) -> DataFrame:
    """The later half of the events lands first, twice; then the earlier half, twice, with the later half once more."""
    landing, out, checkpoint = t.scratch("landing"), t.scratch("events"), t.scratch("checkpoint")
    events = t["events"].select("event_id", F.col("ts").cast("timestamp").alias("ts"))
    later = F.col("ts") >= F.expr(_MIDDLE)
    for parts in ([later, later], [~later, ~later, later]):
        for part in parts:
            events.where(part).write.mode("append").parquet(landing)
        stream = readers.stream_source(t.spark, landing, "parquet", events.schema)
        week = timedelta(days=7)
        distinct.append_distinct(stream, out, checkpoint, ("event_id",), "ts", timedelta(hours=1), horizon=week)
    rows = distinct.distinct_rows(t.spark, out, events.schema)
    counts = distinct.arrivals(t.spark, out, events.schema).where(F.col("kind") == distinct.DUPLICATE)
    one = F.lit(1).cast("bigint").alias("rows")
    kept = rows.select(F.col("event_id").cast("string").alias("event_id"), F.col(distinct.KIND).alias("kind"), one)
    return kept.union(counts.select(F.lit("all").alias("event_id"), "kind", "rows"))
