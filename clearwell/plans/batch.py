"""One pass from raw rows to clean and quarantined rows with their metrics."""

from __future__ import annotations

import logging
import zlib
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from clearwell.contracts import Contract, contract_for
from clearwell.functions.names import column
from clearwell.functions.values import DATE_PARTS
from clearwell.operators.quality import (
    BLANK,
    CLEAN,
    QUARANTINE,
    REASON,
    ZONE,
    failure_reason,
    log_verdict,
    zone_metrics,
)
from clearwell.operators.shape import (
    CAST_FAILURES,
    COPIES,
    SOURCE_FILE,
    add_date_partitions,
    all_null,
    apply_contract,
    count_copies,
    normalize_names,
    union_by_name,
    with_source_file,
)
from clearwell.session import folder_bytes, pin, widened_shuffles
from clearwell.sinks.catalog import add_partitions, register_table
from clearwell.sinks.compaction import (
    RUN,
    State,
    bytes_below,
    clear,
    live_batches,
    release,
    run_path,
    runs_path,
    save_state,
    state_of,
)
from clearwell.sinks.manifest import Extra, Publication, extras_of, label_of, note_extras, settle_columns
from clearwell.sinks.writers import (
    BATCH,
    SOURCE_MARK,
    batch_path,
    checked_id,
    clustered,
    drop_folders,
    in_batch,
    write_batch,
    write_clean,
    write_quarantine,
    write_sizes,
)
from clearwell.sources.files import UnreadableFile, group_files, read_group
from clearwell.sources.ledger import LandedFile, Ledger
from clearwell.sources.readers import CORRUPT, read_partitioned, read_source

log = logging.getLogger(__name__)

_BLANK_ROW = "_blank_row"
_MARKS = f"`{COPIES}` bigint, `{CAST_FAILURES}` int, `{REASON}` string"
_FOLDERS = (ZONE, *DATE_PARTS)

QUALITY_RUNS = "quality_runs"
RUN_COLUMNS = {
    "raw_count": "bigint",
    "clean_count": "bigint",
    "quarantine_count": "bigint",
    "duplicate_count": "bigint",
    "all_null_count": "bigint",
    "cast_failure_count": "bigint",
    "pass_rate_pct": "double",
    "below_threshold": "boolean",
}


def mark_batch(
    df: DataFrame,
    contract: Contract,
    run_ts: datetime | None = None,
    strict: bool = False,
) -> DataFrame:
    """Every distinct raw row, typed and dated, with the zone it belongs to.

    Names, duplicates, empty rows, types, dates and rules in this order. No row
    is filtered out here: good rows are in zone ``clean``, rows that break a rule
    in ``quarantine`` with the reason, the all-null row in ``blank``, each with the
    number of raw rows it stands for. With a ``_source_file`` column only copies
    within one file are duplicates. A row with a ``_corrupt_record`` did not parse: it
    is in quarantine for that, with its text.
    """
    counted = count_copies(normalize_names(df))
    data = [name for name in counted.columns if name not in (COPIES, SOURCE_FILE)]
    flagged = counted.withColumn(_BLANK_ROW, all_null(data))
    typed = apply_contract(flagged, contract, strict=strict, count_failures=True)
    dated = add_date_partitions(typed, contract.date_column, run_ts)
    blank = F.col(_BLANK_ROW)
    reason = F.when(~blank, failure_reason(dated.columns, contract.not_null, contract.positive))
    if CORRUPT in data:
        reason = F.when(F.col(CORRUPT).isNotNull(), "corrupt_record").otherwise(reason)
    ruled = dated.withColumn(REASON, reason)
    zone = F.when(blank, BLANK).when(F.col(REASON).isNull(), CLEAN).otherwise(QUARANTINE)
    technical = (COPIES, CAST_FAILURES, _BLANK_ROW, REASON, *DATE_PARTS)
    kept = [name for name in ruled.columns if name not in technical]
    return ruled.select(
        *[F.col(f"`{name}`") for name in kept], COPIES, CAST_FAILURES, REASON, zone.alias(ZONE), *DATE_PARTS
    )


def table_path(lake: str, table: str) -> str:
    return f"{lake.rstrip('/')}/{table}"


def run_batch(
    df: DataFrame,
    contract: Contract,
    lake: str,
    batch_id: str,
    run_ts: datetime | None = None,
    strict: bool = False,
    input_bytes: int | None = None,
) -> dict:
    """Write one batch of raw rows and return its metrics.

    The rows are read, shuffled and written once. The metrics are an aggregate
    over three narrow columns of what was written, and are kept as a row of the
    ``quality_runs`` table. Running a batch id again replaces its rows. Columns beyond
    the contract are noted, so that readers of the table find them (``sinks.manifest``).
    """
    spark = pin(df.sparkSession)
    path = table_path(lake, contract.name)
    checked_id(batch_id)
    with widened_shuffles(spark, input_bytes):
        marked = mark_batch(df, contract, run_ts, strict)
        settled = settle_columns(spark, lake, contract, batch_id, marked, (COPIES, CAST_FAILURES, REASON, *_FOLDERS))
        release(spark, lake, contract.name, batch_id)
        write_batch(settled, path, batch_id, input_bytes=input_bytes)
    written = read_partitioned(spark, batch_path(path, batch_id), _MARKS, _FOLDERS)
    metrics = zone_metrics(written).first().asDict()
    run = spark.range(0, 1, 1, 1).select(
        *[F.lit(metrics[name]).cast(kind).alias(name) for name, kind in RUN_COLUMNS.items()]
    )
    runs = f"{table_path(lake, QUALITY_RUNS)}/table={contract.name}"
    run.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(batch_path(runs, batch_id))
    log_verdict(contract.name, metrics)
    return metrics


def quality_runs(spark: SparkSession, lake: str) -> DataFrame:
    """One row per table, batch and source; ``source`` is NULL for a batch without named sources."""
    schema = ", ".join(f"`{name}` {kind}" for name, kind in RUN_COLUMNS.items())
    runs = read_partitioned(spark, table_path(lake, QUALITY_RUNS), schema, ("table", BATCH))
    return runs.withColumn("source", F.get(F.split(BATCH, SOURCE_MARK), F.lit(1)))


def contract_ddl(contract: Contract, extras: str = "") -> str:
    columns = ", ".join(f"`{name}` {kind}" for name, kind in contract.columns.items())
    return ", ".join(part for part in (columns, extras) if part)


def marked_rows(
    spark: SparkSession,
    lake: str,
    contract: Contract,
    extras: str | None = None,
    batches: Sequence[str] | None = None,
) -> DataFrame:
    """All batches of a table with marks and zones, or ``batches`` alone, whose folders are then all that is listed.

    Columns beyond the contract are those that any batch has; a column that came in several types
    is text. ``extras``, the DDL of such columns, names the ones to read instead, and their types.
    """
    found, wanted = _extras(spark, lake, contract, extras)
    state = state_of(spark, lake, contract.name)
    if batches is None:
        rows = _stored_rows(spark, lake, contract, found, state)
    else:
        inside = [id_ for id_ in batches if id_ in state.batches]
        runs = {run: state.runs[run] for run in {state.batches[id_] for id_ in inside}}
        outside = [id_ for id_ in batches if id_ not in state.batches]
        if not batches:
            raise ValueError("name a batch")
        rows = _stored_rows(spark, lake, contract, found, replace(state, runs=runs), outside)
        rows = rows.where(F.col(BATCH).isin(list(batches)))
    values = [
        extra.value()
        if wanted is None or (not extra.drifted and extra.kind == wanted[extra.name].json())
        else extra.value().try_cast(wanted[extra.name]).alias(extra.name)
        for extra in found
    ]
    marks = [field.name for field in _fields(_MARKS)]
    return rows.select(*map(column, contract.columns), *values, *marks, BATCH, *_FOLDERS)


def _stored_rows(
    spark: SparkSession,
    lake: str,
    contract: Contract,
    found: Sequence[Extra],
    state: State,
    batches: Sequence[str] | None = None,
) -> DataFrame:
    """The rows of batch folders, all or some of them, and of compacted runs, with the columns as they are stored."""
    data = [*_fields(contract_ddl(contract)), *[field for extra in found for field in extra.stored()], *_fields(_MARKS)]
    batch, run = StructField(BATCH, StringType()), StructField(RUN, StringType())
    folders = [StructField(name, StringType()) for name in _FOLDERS]
    names = [column(field.name) for field in (*data, batch, *folders)]
    path = table_path(lake, contract.name)
    reader = spark.read.schema(StructType([*data, batch, *folders])).option("basePath", path)
    paths = [path] if batches is None else [batch_path(path, id_) for id_ in batches]
    parts = [reader.parquet(*paths).where(state.in_folders())] if paths else []
    if state.runs:
        reader = spark.read.schema(StructType([*data, batch, run, *folders]))
        runs = reader.option("basePath", runs_path(lake, contract.name))
        runs = runs.parquet(*[run_path(lake, contract.name, number) for number in sorted(state.runs)])
        parts.append(runs.where(state.in_runs()))
    return reduce(DataFrame.union, [part.select(*names) for part in parts])


def compact(spark: SparkSession, lake: str, contract: Contract) -> int:
    """Bring the rows of all batch folders together in one run of few files a day; how many folders and runs it took.

    Runs no larger than what is gathered are merged with it. So each run is larger than all later
    ones together: a table has at most a logarithm of its size in runs, a day about as many files for
    each 128 MB, and a row is written again at most so many times. Rows, columns, zones and batch ids
    stay, and a batch can still be written again. The folders taken are deleted by the next call. A
    call that ends early changes nothing. Like batches, compactions of one table run one after another.
    """
    pin(spark)
    path = table_path(lake, contract.name)
    state = clear(spark, lake, contract.name, path)
    live = live_batches(spark, path)
    if not live:
        return 0
    size, merged = bytes_below(spark, [batch_path(path, id_) for id_ in live]), []
    for run in sorted(state.runs, key=int, reverse=True):
        if state.runs[run] > size:
            break
        merged.append(run)
        size += state.runs[run]
    if len(live) + len(merged) < 2:
        return 0
    found = extras_of(spark, lake, contract.name)
    # From now on no batch, written again, can bring such a column in another type.
    note_extras(spark, lake, contract, found)
    taken = replace(state, runs={run: state.runs[run] for run in merged})
    number = str(max(map(int, [*state.runs, *state.batches.values(), "0"])) + 1)
    target = run_path(lake, contract.name, number)
    with widened_shuffles(spark, size), write_sizes(spark):
        rows = clustered(_stored_rows(spark, lake, contract, found, taken, live), *_FOLDERS)
        rows.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(*_FOLDERS).parquet(target)
    kept = {run: held for run, held in state.runs.items() if run not in merged}
    moved = [id_ for id_, run in state.batches.items() if run in merged] + live
    save_state(
        spark,
        lake,
        contract.name,
        State(
            state.version,
            kept | {number: bytes_below(spark, [target])},
            state.batches | dict.fromkeys(moved, number),
            frozenset((id_, run) for id_, run in state.replaced if run in kept),
            frozenset(live),
            frozenset(merged),
        ),
    )
    return len(live) + len(merged)


def _fields(ddl: str) -> list[StructField]:
    return StructType.fromDDL(ddl).fields if ddl else []


def _extras(spark: SparkSession, lake: str, contract: Contract, ddl: str | None) -> tuple[list[Extra], dict | None]:
    """Columns beyond the contract, all or those of a DDL, as they are stored; the types the DDL asks for."""
    found = extras_of(spark, lake, contract.name)
    if ddl is None:
        return found, None
    known = {extra.name: extra for extra in found}
    asked = _fields(ddl)
    return (
        [known.get(field.name, Extra(field.name, field.dataType.json())) for field in asked],
        {field.name: field.dataType for field in asked},
    )


def clean_rows(spark: SparkSession, lake: str, contract: Contract, extras: str | None = None) -> DataFrame:
    """The good rows of a table, without marks."""
    rows = marked_rows(spark, lake, contract, extras)
    hidden = () if extras is not None else (SOURCE_FILE, CORRUPT)
    return rows.filter(F.col(ZONE) == CLEAN).drop(COPIES, CAST_FAILURES, REASON, ZONE, *hidden)


def quarantine_rows(spark: SparkSession, lake: str, contract: Contract, extras: str | None = None) -> DataFrame:
    """The bad rows of a table with the rule each one breaks, and the text of those that did not parse."""
    rows = marked_rows(spark, lake, contract, extras)
    hidden = () if extras is not None else (SOURCE_FILE,)
    return rows.filter(F.col(ZONE) == QUARANTINE).drop(COPIES, CAST_FAILURES, ZONE, *hidden)


def publish_batch(
    spark: SparkSession,
    lake: str,
    contract: Contract,
    batch_id: str,
    data_path: str,
    quarantine_path: str,
    source: str,
    extras: str | None = None,
) -> None:
    """Copy a written batch to separate clean and quarantine folders.

    For readers that expect ``year=/month=/day=`` at the top of the clean folder and
    ``source=`` at the top of the quarantine folder. The batch on disk is the common
    input of both writes, so the duplicates are not removed twice. Publishing a
    batch again replaces its folders: those that it has no rows for any more go away. What
    other tables, sources and batches published in the same folders stays.

    Each of the two folders has a manifest. A publication is noted when its rows are there and
    before old folders go: ``sinks.manifest.published_rows`` has the rows of the latest one also
    where a run ended in between, and the next publication deletes what is left over.
    """
    for root, rows, tagged in (
        (data_path, clean_rows(spark, lake, contract, extras), False),
        (quarantine_path, quarantine_rows(spark, lake, contract, extras), True),
    ):
        _publish(spark, rows.filter(in_batch(batch_id)), Publication(root, contract.name, source, batch_id), tagged)


def _publish(spark: SparkSession, rows: DataFrame, place: Publication, tagged: bool) -> None:
    label = label_of(spark, place)
    if tagged:
        write_quarantine(rows, place.root, place.source, "overwrite", label)
    else:
        write_clean(rows, place.root, "overwrite", label)
    days = [tuple(row) for row in rows.select(*DATE_PARTS).distinct().collect()]
    earlier = place.notes(spark)
    place.note(spark, max((note["version"] for note in earlier), default=0) + 1, label, days)
    _clear(spark, place, earlier, days, tagged)


def _clear(spark: SparkSession, place: Publication, earlier: list[dict], days: list[tuple], tagged: bool) -> None:
    """Delete the folders of earlier publications of the same place that the last one has no rows for."""
    gone = {(*(note[name] for name in DATE_PARTS), note["label"]) for note in earlier if not note["empty"]}
    gone = sorted((row for row in gone if row[:-1] not in set(days)), key=str)
    folders = (*DATE_PARTS, BATCH)
    if tagged:
        drop_folders(spark, place.root, ("source", *folders), [(place.source, *row) for row in gone])
    else:
        drop_folders(spark, place.root, folders, gone)


def register_lake_table(
    spark: SparkSession,
    lake: str,
    contract: Contract,
    database: str,
    extras: str | None = None,
    batch_id: str | None = None,
) -> None:
    """Make a table of the lake available to SQL.

    ``<name>_batches`` has the rows of batch folders with their marks, ``<name>_runs`` those of
    compacted runs, the view ``<name>`` the clean rows of both and the view ``<name>_quarantine`` the
    bad ones, with the columns that any batch has (or the contract and ``extras``). Call it again to pick up
    new batches and after a compaction: with ``batch_id`` only the folders of that batch, and of runs not
    yet defined, are listed, and not those of the whole table.
    """
    found, _ = _extras(spark, lake, contract, extras)
    stored = [f"`{field.name}` {field.dataType.simpleString()}" for extra in found for field in extra.stored()]
    data = ", ".join(part for part in (contract_ddl(contract), *stored, _MARKS) if part)
    state = state_of(spark, lake, contract.name)
    path, parts = table_path(lake, contract.name), (BATCH, *_FOLDERS)
    table = f"`{database}`.`{contract.name}_batches`"
    register_table(spark, table, path, data, parts, recover=batch_id is None)
    if batch_id is not None:
        for own in live_batches(spark, path):
            if own.split(SOURCE_MARK)[0] == batch_id and own not in state.taken:
                add_partitions(spark, table, parts, _places(spark, batch_path(path, own), own))
        spark.catalog.refreshTable(table)
    places = f"SELECT * FROM {table} WHERE {state.folders_sql()}"
    if state.runs:
        runs, parts = f"`{database}`.`{contract.name}_runs`", (RUN, *_FOLDERS)
        register_table(spark, runs, runs_path(lake, contract.name), f"{data}, `{BATCH}` string", parts, recover=False)
        for run in state.runs:
            if spark.sql(f"SHOW PARTITIONS {runs} PARTITION (`{RUN}` = '{run}')").isEmpty():
                add_partitions(spark, runs, parts, _places(spark, run_path(lake, contract.name, run), run))
        same = ", ".join(f"`{field.name}`" for field in (*_fields(data), *_fields(f"`{BATCH}` string"))) + ", "
        same += ", ".join(f"`{name}`" for name in _FOLDERS)
        places = (
            f"SELECT {same} FROM {table} WHERE {state.folders_sql()}"
            f" UNION ALL SELECT {same} FROM {runs} WHERE {state.runs_sql()}"
        )
    shown = [extra.sql() for extra in found if extras is not None or extra.name not in (SOURCE_FILE, CORRUPT)]
    names = ", ".join([*[f"`{name}`" for name in contract.columns], *shown, *DATE_PARTS])
    for view, more, zone in ((contract.name, "", CLEAN), (f"{contract.name}_quarantine", f", `{REASON}`", QUARANTINE)):
        spark.sql(
            f"CREATE OR REPLACE VIEW `{database}`.`{view}` AS SELECT {names}{more}"
            f" FROM ({places}) WHERE `{ZONE}` = '{zone}'"
        )


def _places(spark: SparkSession, path: str, first: str) -> list[tuple[str | None, ...]]:
    """The partitions below one folder, as many as it has zones and days; no column of the files is read."""
    rows = read_partitioned(spark, path, _MARKS, _FOLDERS).select(*_FOLDERS).distinct().collect()
    return [(first, *row) for row in rows]


@dataclass(frozen=True)
class Source:
    """Landed files of one table.

    ``more`` is stacked under them by tidied column name; ``options`` go to the
    reader. ``name`` tells the sources of a batch apart; by default it follows
    from the path and the format.
    """

    path: str
    fmt: str
    table: str
    more: DataFrame | None = None
    options: Mapping[str, str] = field(default_factory=dict)
    name: str | None = None

    @property
    def key(self) -> str:
        return self.name or f"{self.fmt}-{zlib.crc32(self.path.encode()):08x}"


def run_sources(
    spark: SparkSession,
    sources: Sequence[Source],
    lake: str,
    batch_id: str,
    mode: str = "infer",
    per_file: bool = False,
    run_ts: datetime | None = None,
) -> DataFrame:
    """Run a batch for each source; the summary has one row per source.

    Each source has a folder of its own in the batch, so several may fill one table and
    running one of them again replaces its rows only. CSV files of different headers are stacked by
    tidied column name; one that cannot be read is set apart in the ledger of the lake.
    """
    keys = [(source.table, source.key) for source in sources]
    if len(set(keys)) < len(keys):
        raise ValueError("sources of one table need different names")
    for source in sources:
        df = _csv_source(spark, source, lake, batch_id, mode, per_file) if source.fmt == "csv" else None
        if df is None:
            df = read_source(spark, source.path, source.fmt, mode=mode, **source.options)
            if per_file:
                df = with_source_file(df)
        if source.more is not None:
            df = union_by_name(normalize_names(df), normalize_names(source.more))
        run_batch(
            df,
            contract_for(source.table),
            lake,
            f"{batch_id}{SOURCE_MARK}{source.key}",
            run_ts=run_ts,
            input_bytes=folder_bytes(spark, source.path),
        )
    return quality_runs(spark, lake).filter(in_batch(batch_id))


def _csv_source(
    spark: SparkSession, source: Source, lake: str, batch_id: str, mode: str, per_file: bool
) -> DataFrame | None:
    """The rows of all readable files of a source; None if its folders hold columns, which the reader has to find."""
    listed = spark.read.format("binaryFile").options(**source.options).load(source.path)
    if len(listed.columns) > 4:
        return None
    rows = listed.select("path", "length", F.unix_millis("modificationTime")).collect()
    files = {row[0]: LandedFile(*row) for row in rows}
    groups, faults = group_files(spark, sorted(files), "csv", **source.options)
    if faults:
        for path, reason in sorted(faults.items()):
            log.warning("%s is set apart: %s", path, reason)
        ledger = Ledger(lake, f"{source.table}-{source.fmt}")
        ledger.note(spark, [files[path] for path in faults], f"{batch_id}{SOURCE_MARK}{source.key}", faults)
    if not groups:
        raise UnreadableFile(f"{source.path} has no file that can be read")
    parts = []
    for group in groups:
        part = read_group(spark, group, infer=mode == "infer")
        parts.append(with_source_file(part) if per_file else part)
    if len(parts) == 1:
        return parts[0]
    return reduce(union_by_name, map(normalize_names, parts))
