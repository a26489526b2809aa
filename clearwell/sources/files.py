"""Landed files one by one: which can be read together, and which not at all.

Headers and footers are looked at before rows are read, a few bytes of each file. Files of one shape
are one read, whatever the shapes of the others; a file without a shape is set apart with the reason.
"""

from __future__ import annotations

import csv
import json
import re
import zlib
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from clearwell.contracts import ContractError
from clearwell.functions.names import column
from clearwell.session import hadoop_path
from clearwell.sources.readers import CORRUPT, inferred_types, reader_options

HEAD_BYTES = 1 << 20
_LOOKS_AT_ONCE = 16
# Signs of a file that cannot be read, in the text of a Spark error; anything else is no fault of a file.
_FAULTS = re.compile(
    "FAILED_READ_FILE|CANNOT_READ_FILE_FOOTER|FAILED_READ_FOOTER|UNABLE_TO_INFER_SCHEMA|PATH_NOT_FOUND"
    "|MALFORMED_RECORD|ZipException|EOFException|not a Parquet file|incorrect header check|invalid"
    " (?:block type|stored block|distance)"
)


class UnreadableFile(ValueError):
    """A file that has no rows to offer."""


def file_fault(error: Exception) -> str | None:
    """What is wrong with the files of a failed read or batch; None if it was something else that failed."""
    if isinstance(error, (UnreadableFile, ContractError)):
        return str(error)
    text = str(error) if isinstance(error, PySparkException) or "Py4JJavaError" in type(error).__name__ else ""
    found = _FAULTS.search(text)
    return found.group() if found else None


@dataclass(frozen=True)
class FileGroup:
    """Files of one shape; ``key`` names it, the same for the same columns."""

    fmt: str
    paths: tuple[str, ...]
    schema: StructType
    options: dict[str, str] = field(default_factory=dict)

    @property
    def key(self) -> str:
        return f"{self.fmt}-{zlib.crc32(self.schema.json().encode()):08x}"

    def of(self, paths: Sequence[str]) -> FileGroup:
        return FileGroup(self.fmt, tuple(paths), self.schema, self.options)


def literal_path(path: str) -> str:
    """A path whose braces, brackets and stars are no pattern."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", path)


def _head(spark: SparkSession, path: str) -> tuple[bytes, bool]:
    files, target = hadoop_path(spark, path)
    data = files.open(target)
    try:
        head = bytes(data.readNBytes(HEAD_BYTES))
    finally:
        data.close()
    whole = len(head) < HEAD_BYTES
    if path.lower().endswith(".gz"):
        try:
            head = zlib.decompressobj(31).decompress(head)
        except zlib.error as error:
            raise UnreadableFile(f"no gzip file: {error}") from error
    return head, whole


def csv_header(spark: SparkSession, path: str, options: dict[str, str]) -> tuple[str, ...]:
    """The names in the first line that is not blank; a nameless column is called by its place."""
    head, whole = _head(spark, path)
    text = head.decode("utf-8-sig", "replace")
    lines = re.split(r"\r\n|\n|\r", text)
    line = next((line for line in (lines if whole else lines[:-1]) if line.strip()), None)
    if line is None:
        raise UnreadableFile("no header")
    if "\0" in line:
        raise UnreadableFile("no text")
    sep = options.get("sep") or options.get("delimiter") or ","
    names = next(csv.reader([line], delimiter=sep, quotechar=options.get("quote") or '"'))
    return tuple(name.strip() or f"_c{k}" for k, name in enumerate(names))


def _text_type(names: Sequence[str]) -> StructType:
    return StructType([StructField(name, StringType()) for name in names])


def _shape(spark: SparkSession, path: str, fmt: str, options: dict[str, str]) -> StructType | Exception:
    try:
        if fmt == "csv":
            return _text_type(csv_header(spark, path, options))
        return spark.read.parquet(literal_path(path)).schema
    except Exception as error:
        if file_fault(error) is None:
            raise
        return error


def _json_shape(spark: SparkSession, paths: list[str], fmt: str, options: dict[str, str], bad: dict[str, str]):
    """The fields of all JSON files together; halves are tried where a file cannot be read."""
    reader = reader_options(spark.read, fmt).options(**options).option("primitivesAsString", True)
    try:
        return [reader.option("columnNameOfCorruptRecord", CORRUPT).json([*map(literal_path, paths)]).schema]
    except Exception as error:
        reason = file_fault(error)
        if reason is None:
            raise
        if len(paths) == 1:
            bad[paths[0]] = reason
            return []
    half = len(paths) // 2
    return [s for part in (paths[:half], paths[half:]) for s in _json_shape(spark, part, fmt, options, bad)]


def group_files(
    spark: SparkSession,
    paths: Sequence[str],
    fmt: str,
    known: StructType | None = None,
    discover: bool = True,
    **options: str,
) -> tuple[list[FileGroup], dict[str, str]]:
    """Files by shape, and the reason for each file that cannot be read.

    CSV files go by their header, Parquet files by their footer. JSON files are one group with the fields of
    all of them, ``known`` ones first and in the types given; without ``discover`` only those, and
    the files are not read for it.
    """
    bad: dict[str, str] = {}
    if fmt in ("json", "jsonl"):
        fields = {f.name: f for f in (known.fields if known else []) if f.name != CORRUPT}
        if discover or not fields:
            for schema in _json_shape(spark, sorted(paths), fmt, options, bad):
                for f in schema.fields:
                    if f.name not in fields and f.name != CORRUPT:
                        fields[f.name] = f
        good = tuple(sorted(set(paths) - set(bad)))
        return ([FileGroup(fmt, good, StructType(list(fields.values())), options)] if good else []), bad
    with ThreadPoolExecutor(_LOOKS_AT_ONCE) as pool:
        shapes = list(pool.map(lambda path: _shape(spark, path, fmt, options), paths))
    groups: dict[str, tuple[StructType, list[str]]] = {}
    for path, shape in zip(paths, shapes, strict=True):
        if isinstance(shape, Exception):
            bad[path] = file_fault(shape) or "unreadable"
        else:
            groups.setdefault(shape.json(), (shape, []))[1].append(path)
    return [FileGroup(fmt, tuple(sorted(own)), schema, options) for _, (schema, own) in sorted(groups.items())], bad


def read_group(spark: SparkSession, group: FileGroup, infer: bool = False) -> DataFrame:
    """The rows of a group, values as text; text that does not fit is kept as ``_corrupt_record``.

    That is JSON that does not parse, and a CSV line with more fields than the header. A line with
    fewer fields is a row whose last values are missing. ``infer`` guesses the types of CSV columns.
    """
    paths = [*map(literal_path, group.paths)]
    if group.fmt == "parquet":
        return spark.read.schema(group.schema).parquet(*paths)
    if CORRUPT in group.schema.names:
        raise UnreadableFile(f"a column is called {CORRUPT}")
    schema = group.schema
    if group.fmt == "csv" and infer:
        schema = inferred_types(spark, paths, schema, group.options)
    reader = reader_options(spark.read, group.fmt).options(**group.options)
    reader = reader.option("columnNameOfCorruptRecord", CORRUPT).schema(StructType([*schema.fields, _CORRUPT_FIELD]))
    if group.fmt != "csv":
        if not group.schema.fields:
            # Nothing parses: the text is all there is.
            text = spark.read.option("wholetext", group.fmt == "json").text(paths)
            return text.where(F.trim("value") != "").select(F.col("value").alias(CORRUPT))
        return reader.json(paths)
    # The header was read, and is the same in all files of the group.
    rows = reader.option("enforceSchema", True).csv(paths)
    sep = re.escape(group.options.get("sep") or group.options.get("delimiter") or ",")
    fields = F.regexp_count(F.col(CORRUPT), F.lit(f'{sep}(?=(?:[^"]*"[^"]*")*[^"]*$)')) + 1
    surplus = F.when(fields >= len(schema), F.col(CORRUPT)).alias(CORRUPT)
    return rows.select(*[column(name) for name in schema.names], surplus)


_CORRUPT_FIELD = StructField(CORRUPT, StringType())


def kinds_of(schema) -> StructType:
    """A schema given as DDL text or as a type."""
    return StructType.fromDDL(schema) if isinstance(schema, str) else StructType.fromJson(json.loads(schema.json()))
