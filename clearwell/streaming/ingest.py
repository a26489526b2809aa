"""New files to batches, each file exactly once."""

from __future__ import annotations

import json
import logging
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from clearwell.contracts import Contract, ContractError
from clearwell.operators.routing import TRIGGERED
from clearwell.operators.shape import SOURCE_FILE, with_source_file
from clearwell.plans.batch import run_batch
from clearwell.session import pin
from clearwell.sinks.writers import SOURCE_MARK, checked_id, write_batch
from clearwell.sources.files import FileGroup, file_fault, group_files, kinds_of, read_group
from clearwell.sources.ledger import LandedFile, Ledger
from clearwell.sources.readers import name_glob, stream_files, stream_source

log = logging.getLogger(__name__)

# Rows of one file in the raw zone: a huge gzipped upload becomes several files.
LANDED_RECORDS = 5_000_000


def for_each_batch(stream: DataFrame, checkpoint: str, write: Callable[[DataFrame, str], None]) -> StreamingQuery:
    """Hand every micro-batch of what is available now to ``write``, then stop.

    ``write`` also gets a name for the micro-batch: the id that the checkpoint has for
    good, and its number. Another checkpoint, also a new one in the same place, has
    another id, so no stream replaces what another one wrote. ``write`` runs batch jobs
    in the stream's own session, where adaptive execution may be off; ``pin``
    switches it on for them.
    """
    names: list[str] = []

    def handle(df: DataFrame, batch: int) -> None:
        spark = pin(df.sparkSession)
        if not names:
            names.append(json.loads(spark.read.text(f"{checkpoint.rstrip('/')}/metadata").first()[0])["id"])
        write(df, f"{names[0]}-{batch:08d}")

    writer = stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
    return writer.foreachBatch(handle).start()


# Options that choose files; all others go to the reader of their content.
_FILE_OPTIONS = ("pathGlobFilter", "recursiveFileLookup", "maxFileAge", "latestFirst", "modifiedAfter", "modifiedBefore")


def ingest_available(
    spark: SparkSession,
    path: str,
    fmt: str,
    schema,
    contract: Contract,
    lake: str,
    checkpoint: str,
    prepare: Callable[[DataFrame], DataFrame] | None = None,
    per_file: bool = True,
    strict: bool = False,
    max_files: int | None = None,
    max_bytes: int | None = None,
    batch_prefix: str = "s",
    discover: bool = True,
    **options: str,
) -> None:
    """Run the batch job over all files that are new since the last call.

    The checkpoint knows the files already offered, and the ledger of the lake those already taken: a
    renewed checkpoint takes no file again that has the path, length and time of change of one that is in the
    tables. A micro-batch that is replayed after a failure has the same files and id and replaces its own rows.

    Files of one header are read together, and are a source of their own in the batch where headers differ.
    A file that cannot be read is set apart in the ledger (``ledger.unreadable_files``) and holds up no other.
    ``schema`` names the fields of JSON files, and others that are found are kept as well; ``discover=False`` saves
    the look at them. JSON text that does not parse, and CSV lines with too many fields, go to quarantine as
    they came, in the column ``_corrupt_record``. ``prepare`` maps the read rows to the raw columns of the table.

    Duplicates are removed within a file, so the result does not depend on how files are grouped into
    micro-batches; ``per_file=False`` widens that to the files of one header in a micro-batch. ``max_files`` or
    ``max_bytes`` cuts a backlog into several micro-batches; shuffles are sized by the files of each.
    """
    pin(spark)
    chosen = {name: value for name, value in options.items() if name in _FILE_OPTIONS}
    reading = {name: value for name, value in options.items() if name not in _FILE_OPTIONS}
    ledger = Ledger(lake, f"{contract.name}-{fmt}")
    known = None if fmt in ("csv", "parquet") else kinds_of(schema)

    def write(offered: DataFrame, name: str) -> None:
        batch_id = f"{batch_prefix}-{name}"
        # Spark lists the files beside one with a bracket in its name twice.
        files = [LandedFile(*row) for row in sorted(set(map(tuple, offered.collect())))]
        session = offered.sparkSession
        fresh = ledger.not_taken(session, files, batch_id)
        if len(fresh) < len(files):
            log.info("%s: %d files were taken before", batch_id, len(files) - len(fresh))
        lengths = {file.path: file.length for file in fresh}
        groups, faults = group_files(session, list(lengths), fmt, known, discover, **reading) if fresh else ([], {})

        def run(group: FileGroup, group_id: str) -> None:
            try:
                rows = read_group(session, group)
                rows = with_source_file(rows) if per_file else rows
                size = sum(lengths[path] for path in group.paths)
                run_batch(prepare(rows) if prepare else rows, contract, lake, group_id, strict=strict, input_bytes=size)
            except Exception as error:
                reason = file_fault(error)
                if reason is None or (strict and isinstance(error, ContractError)):
                    raise
                if len(group.paths) == 1:
                    faults[group.paths[0]] = reason
                    return
                half = len(group.paths) // 2
                for part, paths in enumerate((group.paths[:half], group.paths[half:])):
                    run(group.of(paths), f"{group_id}{'.' if SOURCE_MARK in group_id else SOURCE_MARK}{part}")

        for group in groups:
            run(group, batch_id if len(groups) == 1 else f"{batch_id}{SOURCE_MARK}{group.key}")
        for file, reason in sorted(faults.items()):
            log.warning("%s is set apart: %s", file, reason)
        ledger.note(session, fresh, batch_id, faults)

    for_each_batch(stream_files(spark, path, max_files, max_bytes, **chosen), checkpoint, write).awaitTermination()


@dataclass(frozen=True)
class Feed:
    """Uploaded files of one format that belong to one table.

    ``schema`` is that of the files; ``pattern`` narrows them down by file name. The
    feeds of one checkpoint folder have different names; by default the table and
    the format make one.
    """

    fmt: str
    contract: Contract
    schema: str
    pattern: str | None = None
    name: str | None = None

    @property
    def key(self) -> str:
        return self.name or f"{self.contract.name}-{self.fmt}"


def ingest_feeds(
    spark: SparkSession,
    path: str,
    feeds: Sequence[Feed],
    lake: str,
    checkpoint: str,
    **limits: int,
) -> None:
    """Take in what is new in a folder of mixed uploads, feed by feed.

    Several feeds may fill the same table.
    """
    names = [feed.key for feed in feeds]
    if len(set(names)) < len(names):
        raise ValueError("feeds of one table and format need different names")
    for feed in feeds:
        ingest_available(
            spark,
            path,
            feed.fmt,
            feed.schema,
            feed.contract,
            lake,
            f"{checkpoint.rstrip('/')}/{feed.key}",
            batch_prefix=feed.fmt,
            pathGlobFilter=feed.pattern or name_glob(feed.fmt),
            **limits,
        )


def deduplicate_stream(stream: DataFrame, ids: Sequence[str], event_time: str, delay: str) -> DataFrame:
    """Drop repeated ids across files, as long as they come within ``delay``.

    State is kept for that time only. A row with a NULL id repeats nothing: it passes
    by, for the rules to judge. Rows older than the watermark are dropped by the
    engine and counted by ``append_available``. The state is split into
    ``spark.sql.shuffle.partitions`` parts when the checkpoint is made, for good.
    """
    unknown = reduce(or_, [F.col(name).isNull() for name in ids])
    marked = stream.withWatermark(event_time, delay)
    return marked.where(~unknown).dropDuplicatesWithinWatermark(list(ids)).union(marked.where(unknown))


def append_available(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    partitions: Sequence[str],
    cluster: bool = True,
    batch_prefix: str = "s",
    max_records_per_file: int = 0,
) -> int:
    """Write what a stream has now, one folder per micro-batch; how many rows were too late.

    A replayed micro-batch replaces its own folder. Rows a watermark shut out are
    counted over all micro-batches and logged as a warning.
    """

    def write(df: DataFrame, name: str) -> None:
        rows = {"max_records_per_file": max_records_per_file}
        write_batch(df, path, f"{batch_prefix}-{name}", partitions, cluster=cluster, **rows)

    late = LateRows()
    stream.sparkSession.streams.addListener(late)
    try:
        query = for_each_batch(stream, checkpoint, write)
        query.awaitTermination()
        # The progress of the last micro-batch comes before the end of the query.
        stream.sparkSession._jsparkSession.sparkContext().listenerBus().waitUntilEmpty(60_000)
    finally:
        stream.sparkSession.streams.removeListener(late)
    dropped = late.of(str(query.runId))
    if dropped:
        log.warning("%d rows came after the watermark and were dropped", dropped)
    return dropped


class LateRows(StreamingQueryListener):
    """Adds up what the state operators drop as too late, however many micro-batches there are."""

    def __init__(self) -> None:
        self._dropped: dict[str, int] = {}

    def of(self, run: str) -> int:
        return self._dropped.get(run, 0)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        dropped = sum(state.numRowsDroppedByWatermark for state in progress.stateOperators)
        self._dropped[str(progress.runId)] = self.of(str(progress.runId)) + dropped


def land_raw(
    spark: SparkSession,
    path: str,
    fmt: str,
    schema,
    raw_path: str,
    checkpoint: str,
    max_files: int | None = None,
    **options: str,
) -> None:
    """Copy new files of one format into the raw zone as Parquet.

    Folders are format, then the date of ingestion in UTC. Rows keep the columns
    they came with and the file they came from. Gzipped text and JSON documents
    can be read by many tasks from there on.
    """
    pin(spark)
    stream = with_source_file(stream_source(spark, path, fmt, schema, max_files, **options))
    moment = F.current_timestamp()
    landed = stream.select(
        "*",
        F.lit(fmt).alias("format"),
        F.date_format(moment, "yyyy").alias("year"),
        F.date_format(moment, "MM").alias("month"),
        F.date_format(moment, "dd").alias("day"),
    )
    # All rows of a micro-batch go to one folder: nothing to bring together first.
    folders = ("format", "year", "month", "day")
    append_available(
        landed, raw_path, checkpoint, folders, cluster=False, batch_prefix=fmt, max_records_per_file=LANDED_RECORDS
    )


LANDED = "_landed"
_COPY_BYTES = 8 * 1024 * 1024


def land_accepted(spark: SparkSession, verdicts: DataFrame, raw_path: str, run_id: str, root: str = "") -> DataFrame:
    """Copy the accepted uploads, and no others, to their places in the raw zone, byte by byte.

    ``verdicts`` come from ``routing.route``; ``root`` stands before their keys. A file goes to its
    ``organized_key`` below ``raw_path``, as it is: nothing is parsed, so its name and content do not matter.
    Uploads that share a place all land: the one of the least key under the plain name, the others with
    the checksum of their key in it. Executors copy a file in pieces and give it its name when it is whole, so a
    repeated run or task puts the same file in the same place. The result has a row for each upload
    (``original_key``, ``landed_path``, ``bytes``) and is kept below ``raw_path`` under the run's id.

    Spark has no sink for files as they are: the copy is Python with Arrow's file systems, which know
    local and mounted paths, S3, HDFS and GCS.
    """
    accepted = verdicts.filter(F.col("status") == TRIGGERED).select("original_key", "organized_key").distinct()
    first = accepted.groupBy("organized_key").agg(F.min("original_key").alias("first_key"))
    mark = F.lpad(F.hex(F.crc32(F.col("original_key").cast("binary"))), 8, "0")
    marked = F.regexp_replace(F.col("organized_key"), r"^(.*/\.*[^./]*)([^/]*)$", F.concat(F.lit("$1-"), mark, F.lit("$2")))
    place = F.when(F.col("original_key") == F.col("first_key"), F.col("organized_key")).otherwise(marked)
    target = F.concat(F.lit(f"{raw_path.rstrip('/')}/"), place)
    copies = accepted.join(first, "organized_key").select(
        "original_key", F.concat(F.lit(root), "original_key").alias("source"), target.alias("landed_path")
    )
    report = f"{raw_path.rstrip('/')}/{LANDED}/{checked_id(run_id)}"
    schema = "original_key string, landed_path string, bytes bigint"
    # Files are dealt out evenly, whatever their names.
    dealt = copies.repartition(max(1, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    dealt.mapInArrow(_copier(_COPY_BYTES), schema).write.mode("overwrite").parquet(report)
    return spark.read.schema(schema).parquet(report)


def _copier(piece: int):
    """The copy as a function that executors get whole: they need not have this package."""

    def store_of(path: str):
        import re

        from pyarrow import fs

        found = re.fullmatch(r"(?s)([a-zA-Z][a-zA-Z0-9+.-]*):(?://([^/]*))?(/.*)", path)
        scheme = found.group(1).lower() if found else "file"
        if scheme == "file":
            return fs.LocalFileSystem(), found.group(3) if found else path, True
        kind = {"s3a": "s3", "s3n": "s3"}.get(scheme, scheme)
        store, base = fs.FileSystem.from_uri(f"{kind}://{found.group(2)}")
        # Object stores show a file when it is closed.
        return store, base.rstrip("/") + found.group(3), kind in ("hdfs", "viewfs")

    def copy(source: str, target: str) -> int:
        import uuid

        store, path, _ = store_of(source)
        goal, place, renames = store_of(target)
        folder, name = place.rsplit("/", 1)
        draft = f"{folder}/.{name}.{uuid.uuid4().hex}" if renames else place
        if renames:
            goal.create_dir(folder, recursive=True)
        size = 0
        with store.open_input_stream(path, compression=None) as data:
            with goal.open_output_stream(draft, compression=None) as out:
                while part := data.read(piece):
                    out.write(part)
                    size += len(part)
        if renames:
            goal.move(draft, place)
        return size

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            keys, sources, targets = (column.to_pylist() for column in batch.columns)
            sizes = [copy(source, target) for source, target in zip(sources, targets, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.string()), pa.array(targets, pa.string()), pa.array(sizes, pa.int64())],
                ["original_key", "landed_path", "bytes"],
            )

    return run
