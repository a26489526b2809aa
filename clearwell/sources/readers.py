"""Batch and streaming readers, chosen by format name."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamReader
from pyspark.sql.types import StructField, StructType

from clearwell.functions.values import DATE_PARTS

FORMATS = ("csv", "json", "jsonl", "parquet")
CORRUPT = "_corrupt_record"

# File names of a format, gzipped text included, in any letter case.
_NAME_GLOB = {
    "csv": "*.{[cC][sS][vV],[cC][sS][vV].[gG][zZ]}",
    "json": "*.{[jJ][sS][oO][nN],[jJ][sS][oO][nN].[gG][zZ]}",
    "jsonl": "*.{[jJ][sS][oO][nN][lL],[jJ][sS][oO][nN][lL].[gG][zZ]}",
    "parquet": "*.[pP][aA][rR][qQ][uU][eE][tT]",
}


def name_glob(fmt: str) -> str:
    """Pattern for ``pathGlobFilter`` that selects the files of one format."""
    return _NAME_GLOB[_known(fmt)]


def _known(fmt: str) -> str:
    if fmt not in FORMATS:
        raise ValueError(f"unsupported format {fmt!r}, expected one of {', '.join(FORMATS)}")
    return fmt


def text_schema(names: Sequence[str], keep_corrupt: bool = False) -> str:
    """Schema of untyped columns, for readers that leave typing to the contract."""
    names = [*names, CORRUPT] if keep_corrupt else names
    return ", ".join(f"`{name}` string" for name in names)


def reader_options(reader, fmt: str):
    """What every read of a format is told."""
    if fmt == "csv":
        # A header that differs from the schema is refused, not read by position.
        return reader.option("header", True).option("enforceSchema", False)
    if fmt == "json":
        return reader.option("multiLine", True)
    return reader


def _load(reader, fmt: str, path) -> DataFrame:
    return reader.format("json" if fmt == "jsonl" else fmt).load(path)


def read_source(
    spark: SparkSession,
    path: str | list[str],
    fmt: str,
    mode: str = "infer",
    columns: Sequence[str] | None = None,
    keep_corrupt: bool = False,
    spread: int | None = None,
    **options: str,
) -> DataFrame:
    """Read landed files of one format; ``.gz`` text is unpacked by its suffix.

    ``mode="infer"`` guesses column types, which reads CSV and JSON twice.
    ``mode="text"`` leaves every value as written, for the contract to cast: with
    ``columns``, the names in file order, nothing is read ahead. ``keep_corrupt``
    adds rows that do not parse as ``_corrupt_record`` (it needs ``columns``).
    A gzipped file or a JSON document is read by one task; ``spread`` deals its
    rows out again for jobs that do not shuffle anyway.
    """
    _known(fmt)
    if mode not in ("infer", "text"):
        raise ValueError(f"mode must be 'infer' or 'text', not {mode!r}")
    if keep_corrupt and not columns:
        raise ValueError("keep_corrupt needs the column names")
    reader: DataFrameReader = reader_options(spark.read, fmt).options(**options)
    if fmt == "parquet":
        df = _load(reader, fmt, path)
    elif mode == "infer":
        df = _load(reader.option("inferSchema", True), fmt, path)
    elif columns:
        schema = text_schema(columns, keep_corrupt)
        df = _load(reader.schema(schema).option("columnNameOfCorruptRecord", CORRUPT), fmt, path)
    else:
        df = _load(reader.option("primitivesAsString", True), fmt, path)
    if fmt in ("json", "jsonl") and df.columns == [CORRUPT]:
        # Nothing parses, so there are no fields: the text is all there is.
        text = spark.read.options(**options).option("wholetext", fmt == "json").text(path)
        df = text.where(F.trim("value") != "").select(F.col("value").alias(CORRUPT))
    return df.repartition(spread) if spread else df


def inferred_types(spark: SparkSession, paths: list[str], names: StructType, options: dict[str, str]) -> StructType:
    """The columns of CSV files of one header in the types their values suggest, which reads the files."""
    reader = reader_options(spark.read, "csv").options(**options).option("inferSchema", True)
    guessed = reader.option("enforceSchema", True).csv(paths).schema
    return StructType([StructField(n.name, g.dataType) for n, g in zip(names.fields, guessed.fields, strict=True)])


def stream_files(spark: SparkSession, path: str, max_files: int | None = None, max_bytes: int | None = None, **options: str):
    """The files below a path as an unbounded table of path, length and time of change; their content is not read."""
    reader = spark.readStream.format("binaryFile").options(**options)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if max_bytes:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    files = reader.schema("path string, modificationTime timestamp, length bigint, content binary").load(path)
    return files.select("path", "length", F.unix_millis("modificationTime").alias("modified"))


def stream_source(
    spark: SparkSession,
    path: str,
    fmt: str,
    schema,
    max_files: int | None = None,
    max_bytes: int | None = None,
    **options: str,
) -> DataFrame:
    """The same files as an unbounded table; one of the limits sizes a batch.

    JSON text that does not parse is kept as ``_corrupt_record``.
    """
    if fmt in ("json", "jsonl") and isinstance(schema, str) and CORRUPT not in schema:
        schema = f"{schema}, `{CORRUPT}` string"
    reader: DataStreamReader = reader_options(spark.readStream, _known(fmt)).options(**options).schema(schema)
    reader = reader.option("columnNameOfCorruptRecord", CORRUPT)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if max_bytes:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    return _load(reader, fmt, path)


def read_partitioned(
    spark: SparkSession,
    path: str,
    schema: str,
    partitions: Sequence[str] = DATE_PARTS,
) -> DataFrame:
    """Read a partitioned Parquet folder with its partition columns as strings.

    ``schema`` lists the data columns as DDL. Without it Spark would turn the
    month ``01`` of a folder name into the number 1.
    """
    folder_columns = ", ".join(f"`{name}` string" for name in partitions)
    return spark.read.schema(f"{schema}, {folder_columns}").parquet(path)


def read_table(spark: SparkSession, table: str) -> DataFrame:
    return spark.table(table)


def list_uploads(spark: SparkSession, path: str) -> DataFrame:
    """The files below a folder as an upload table; their content is not read.

    Spark's listing leaves out files of length 0, so those are only seen through
    upload notifications.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.select(
        F.col("path").alias("original_key"),
        F.col("length").alias("size"),
        F.col("modificationTime").alias("uploaded_at"),
    )


def preview(df: DataFrame, rows: int = 5) -> DataFrame:
    """A first look at a table: any few of its rows."""
    return df.limit(rows)


def ddl(df: DataFrame, without: Sequence[str] = ()) -> str:
    """The columns of a table as DDL, for readers and table definitions."""
    return ", ".join(f"`{name}` {kind}" for name, kind in df.dtypes if name not in without)
