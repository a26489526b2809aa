"""Rows of a stream once for each id, also those that come late.

Ids are settled against what is stored, not against a state that forgets: a row that comes after the
watermark is kept and marked, and is dropped only if its id is there already. Every row that came is
accounted for in the folder it went to, so counts follow from a listing of three kinds.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import UTC, datetime, timedelta
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from clearwell.functions.names import column
from clearwell.session import hadoop_path
from clearwell.sinks.manifest import read_json, write_json
from clearwell.sinks.writers import BATCH, write_batch
from clearwell.streaming.ingest import for_each_batch

KIND, DAY, COPIES = "_kind", "_day", "_copies"
IN_TIME, LATE, DUPLICATE = "in_time", "late", "duplicate"
_PROGRESS = "_progress"
_FOLDERS = (BATCH, KIND, DAY)


def append_distinct(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    ids: Sequence[str],
    event_time: str,
    delay: timedelta,
    horizon: timedelta | None = None,
    batch_prefix: str = "s",
) -> None:
    """Write what a stream has now, one folder per micro-batch, kind and day of event.

    Of the rows of one id in a micro-batch the earliest stays, with the number of its copies; it is a
    ``duplicate`` if an earlier micro-batch stored the id, ``late`` if it is older than the latest event
    before the micro-batch less ``delay``, else ``in_time``. Rows with a NULL id repeat nothing. Stored
    ids are read for the days of the micro-batch, ``horizon`` wider on both sides; without one, for all days.
    A micro-batch that is replayed replaces its own rows and sees what it saw the first time.
    """
    schema = stream.schema

    def write(df: DataFrame, name: str) -> None:
        batch_id = f"{batch_prefix}-{name}"
        spark = df.sparkSession
        before = _latest_before(spark, path, batch_id)
        unknown = reduce(or_, [column(key).isNull() for key in ids])
        moment = column(event_time)
        row = F.struct(*[column(name) for name in df.columns])
        # Copies are combined before the shuffle: a hot id leaves each task once.
        once = df.where(~unknown).groupBy(*map(column, ids)).agg(
            F.count(F.lit(1)).alias(COPIES), F.min_by(row, F.coalesce(moment, F.lit(datetime.max))).alias("_row")
        )
        once = once.select("_row.*", COPIES)
        stored = _stored_ids(spark, df, path, schema, batch_id, ids, event_time, horizon)
        if stored is None:
            known = once.withColumn("_known", F.lit(False))
        else:
            known = once.join(stored.withColumn("_known", F.lit(True)), list(ids), "left")
        rows = known.select(*map(column, df.columns), COPIES, F.coalesce("_known", F.lit(False)).alias("_known"))
        nameless = df.where(unknown).withColumns({COPIES: F.lit(1).cast("bigint"), "_known": F.lit(False)})
        late = moment < F.lit(before - delay) if before else F.lit(False)
        kind = F.when(F.col("_known"), DUPLICATE).when(late, LATE).otherwise(IN_TIME)
        day = F.date_format(moment, "yyyy-MM-dd")
        marked = rows.unionByName(nameless).select(
            *map(column, df.columns), COPIES, kind.alias(KIND), day.alias(DAY)
        )
        write_batch(marked, path, batch_id, (KIND, DAY))
        _note_latest(spark, path, schema, batch_id, event_time, before)

    for_each_batch(stream, checkpoint, write).awaitTermination()


def stored_rows(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Everything that came: the rows with their copies, batch, kind and day."""
    kinds = ", ".join(f"`{name}` string" for name in _FOLDERS)
    more = StructType.fromDDL(f"`{COPIES}` bigint, {kinds}")
    return spark.read.schema(StructType([*schema.fields, *more.fields])).parquet(path)


def distinct_rows(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The rows without the repeated ones."""
    return stored_rows(spark, path, schema).where(F.col(KIND) != DUPLICATE)


def arrivals(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Rows by kind; copies within a micro-batch are duplicates too."""
    rows = stored_rows(spark, path, schema)
    copies = F.when(F.col(KIND) == DUPLICATE, F.col(COPIES)).otherwise(F.col(COPIES) - 1)
    kept = rows.where(F.col(KIND) != DUPLICATE).groupBy(F.col(KIND).alias("kind")).agg(F.count(F.lit(1)).alias("rows"))
    again = rows.agg(F.coalesce(F.sum(copies), F.lit(0)).alias("rows"))
    return kept.union(again.select(F.lit(DUPLICATE).alias("kind"), "rows"))


def _stored_ids(spark, df, path, schema, batch_id, ids, event_time, horizon) -> DataFrame | None:
    files, folder = hadoop_path(spark, path)
    if not files.exists(folder) or not any(
        s.getPath().getName().startswith(f"{BATCH}=") for s in files.listStatus(folder)
    ):
        return None
    kept = distinct_rows(spark, path, schema).where(F.col(BATCH) != batch_id)
    if horizon is not None:
        first, last = df.agg(F.min(column(event_time)), F.max(column(event_time))).first()
        if first is not None:
            days = [(first - horizon).strftime("%Y-%m-%d"), (last + horizon).strftime("%Y-%m-%d")]
            # Rows without a time are of no day, so they are always looked at.
            kept = kept.where(F.col(DAY).between(*days) | F.col(DAY).isNull())
    return kept.select(*map(column, ids))


def _progress_path(path: str) -> str:
    return f"{path.rstrip('/')}/{_PROGRESS}"


def _latest_before(spark: SparkSession, path: str, batch_id: str) -> datetime | None:
    """The latest event of all micro-batches before this one."""
    notes = read_json(spark, _progress_path(path))
    if not notes:
        return None
    moment = notes[0]["before"] if notes[0]["batch"] == batch_id else notes[0]["latest"]
    return datetime.fromtimestamp(moment, UTC) if moment is not None else None


def _note_latest(spark, path, schema, batch_id, event_time, before) -> None:
    own = stored_rows(spark, path, schema).where(F.col(BATCH) == batch_id)
    latest = own.agg(F.max(column(event_time)).cast("timestamp").cast("double")).first()[0]
    earlier = before.timestamp() if before else None
    moments = [moment for moment in (latest, earlier) if moment is not None]
    note = {"batch": batch_id, "before": earlier, "latest": max(moments, default=None)}
    write_json(spark, f"{_progress_path(path)}/latest.json", [note])
