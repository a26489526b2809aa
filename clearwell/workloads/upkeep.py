"""Tables over many batches: compaction, partitions of one batch, results kept up to date."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clearwell.contracts import EVENTS, ORDERS, Contract
from clearwell.functions.names import column
from clearwell.functions.values import DATE_PARTS
from clearwell.operators import quality
from clearwell.plans import batch, incremental
from clearwell.sinks import catalog
from clearwell.sinks.writers import BATCH
from clearwell.workloads import shapes
from clearwell.workloads.batches import _comparable, _raw_events
from clearwell.workloads.registry import Tables, query
from clearwell.workloads.shapes import SQL_MARKED_ORDERS

_PARTS = 4
_SQL_EVENT_ROWS = f"""
    SELECT event_id, user_id, event_type, session_id, device, country, ts AS timestamp,
        CAST(event_id AS BIGINT) % {_PARTS} AS part, {shapes.SQL_DATE_PARTS.format("ts")}
    FROM e
"""


def _event_batches(t: Tables, lake: str, parts: range = range(_PARTS)) -> None:
    """Batches that all have rows of every day."""
    events = _raw_events(t)
    part = F.col("event_id").cast("bigint") % _PARTS
    for k in parts:
        batch.run_batch(events.where(part == k), EVENTS, lake, f"part-{k}")


def _shown(t: Tables, lake: str) -> DataFrame:
    rows = batch.clean_rows(t.spark, lake, EVENTS)
    named = rows.withColumn("part", F.split(BATCH, "-")[1].cast("bigint"))
    return _comparable(named.drop("page", "order_id"))


@query(f"WITH e AS ({shapes.SQL_EVENTS}) {_SQL_EVENT_ROWS}")
def compacted_table(t: Tables) -> DataFrame:
    """Batches in a run, a run merged with a later batch: the same rows, each under its batch."""
    lake = t.scratch("lake")
    _event_batches(t, lake, range(_PARTS - 1))
    batch.compact(t.spark, lake, EVENTS)
    _event_batches(t, lake, range(_PARTS - 1, _PARTS))
    batch.compact(t.spark, lake, EVENTS)
    batch.compact(t.spark, lake, EVENTS)
    return _shown(t, lake)


@query(f"""
    WITH e AS ({shapes.SQL_EVENTS}), r AS ({_SQL_EVENT_ROWS})
    SELECT year, month, day, count(*) AS event_count, CAST(1 AS BIGINT) AS file_count FROM r GROUP BY year, month, day
""")
def compacted_days(t: Tables) -> DataFrame:
    """Files of a day after a compaction: one for each 128 MB."""
    lake = t.scratch("lake")
    _event_batches(t, lake)
    batch.compact(t.spark, lake, EVENTS)
    rows = batch.clean_rows(t.spark, lake, EVENTS).withColumn("file", F.input_file_name())
    counts = (F.count(F.lit(1)).alias("event_count"), F.count_distinct("file").alias("file_count"))
    return rows.groupBy(*DATE_PARTS).agg(*counts)


@query(f"""
    WITH e AS ({shapes.SQL_EVENTS}), r AS ({_SQL_EVENT_ROWS})
    SELECT * FROM r WHERE part <> 1 OR event_type = 'click'
""")
def compacted_then_replaced(t: Tables) -> DataFrame:
    """A batch that is in a run already is written again: its new rows count, its old ones do not."""
    lake = t.scratch("lake")
    _event_batches(t, lake)
    batch.compact(t.spark, lake, EVENTS)
    again = _raw_events(t).where(F.col("event_id").cast("bigint") % _PARTS == 1).where("event_type = 'click'")
    batch.run_batch(again, EVENTS, lake, "part-1")
    return _shown(t, lake)


@query(f"""
    WITH e AS ({shapes.SQL_EVENTS}), r AS ({_SQL_EVENT_ROWS})
    SELECT part, event_type, count(*) AS event_count FROM r GROUP BY part, event_type
""")
def catalog_by_batch(t: Tables) -> DataFrame:
    """Tables that take up the partitions of one batch, and of a run, and list no other folders."""
    lake, database = t.scratch("lake"), catalog.database_name("clear-well", uuid.uuid4().hex)
    catalog.ensure_database(t.spark, database, t.scratch("database"))
    for k in range(_PARTS):
        _event_batches(t, lake, range(k, k + 1))
        if k == _PARTS - 2:
            batch.compact(t.spark, lake, EVENTS)
        batch.register_lake_table(t.spark, lake, EVENTS, database, batch_id=f"part-{k}")
    return t.spark.sql(f"""
        SELECT CAST(event_id AS BIGINT) % {_PARTS} AS part, event_type, count(*) AS event_count
        FROM {database}.events GROUP BY 1, 2
    """)


@query(f"""
    WITH {SQL_MARKED_ORDERS}
    SELECT year, month, day, count(*) AS total_orders,
        CAST(sum(CAST(total_amount AS DECIMAL(18, 2))) AS DOUBLE) AS daily_revenue,
        CAST(sum(CAST(total_amount AS DECIMAL(18, 2))) AS DOUBLE) / count(total_amount) AS avg_order_value,
        count(DISTINCT customer_id) AS unique_customers
    FROM marked WHERE zone = 'clean' AND status <> 'F' GROUP BY year, month, day
""")
def incremental_daily_revenue(t: Tables) -> DataFrame:
    """The stored report after a batch, another over the same days, and that one written again."""
    lake = t.scratch("lake")
    raw = shapes.messy_orders(t)
    # Exact copies stay in one batch.
    late = F.pmod(F.xxhash64(*map(column, raw.columns)), F.lit(4)) == 0
    for rows, name in (
        (raw.where(~late), "early"),
        (raw.where(late).where("Status = 'P'"), "late"),
        (raw.where(late), "late"),
    ):
        batch.run_batch(rows, ORDERS, lake, name)
        incremental.refresh_daily_revenue(t.spark, lake, ORDERS, "F")
    return incremental.kept_daily_revenue(t.spark, lake)


_MEASURED = Contract(
    "measured", columns={"event_id": "bigint", "user_id": "bigint", "value": "double", "ts": "timestamp_ntz"}, date_column="ts"
)


@query("""
    SELECT column_name, count(*) AS row_count, count(filled) AS filled_count, true AS distinct_within, true AS median_within
    FROM (
        SELECT 'event_id' AS column_name, CAST(event_id AS VARCHAR) AS filled FROM events
        UNION ALL SELECT 'user_id', CAST(user_id AS VARCHAR) FROM events
        UNION ALL SELECT 'value', CAST(value AS VARCHAR) FROM events
        UNION ALL SELECT 'ts', CAST(ts AS VARCHAR) FROM events
    ) GROUP BY column_name
""")
def profile_over_batches(t: Tables) -> DataFrame:
    """Sketches of three batches merged, held against exact counts and ranks of all rows."""
    lake, events = t.scratch("lake"), t["events"].select(*_MEASURED.columns)
    for k in range(3):
        batch.run_batch(events.where(F.col("event_id") % 3 == k), _MEASURED, lake, f"part-{k}")
        incremental.refresh_profile(t.spark, lake, _MEASURED)
    kept = incremental.kept_profile(t.spark, lake, _MEASURED)
    exact = quality.profile(events, exact=True).select("column_name", F.col("distinct_count").alias("exact_count"))
    numbers = [name for name, kind in _MEASURED.columns.items() if kind in ("bigint", "double")]
    listed = F.explode(F.array(*[F.struct(F.lit(n).alias("column_name"), F.col(n).cast("double").alias("v")) for n in numbers]))
    medians = kept.select("column_name", F.get("quantiles", F.lit(2)).alias("median"))
    # The rank of a value that occurs often is a range.
    shares = events.select(listed.alias("e")).select("e.*").where("v IS NOT NULL").join(medians, "column_name")
    shares = shares.groupBy("column_name").agg(
        (F.avg((F.col("v") < F.col("median")).cast("int")) <= 0.53).alias("low"),
        (F.avg((F.col("v") <= F.col("median")).cast("int")) >= 0.47).alias("high"),
    )
    near = F.abs(F.col("distinct_count") - F.col("exact_count")) <= 0.04 * F.col("exact_count")
    return kept.join(exact, "column_name").join(shares, "column_name", "left").select(
        "column_name",
        "row_count",
        "filled_count",
        near.alias("distinct_within"),
        F.coalesce(F.expr("low AND high"), F.lit(True)).alias("median_within"),
    )
