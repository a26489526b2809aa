"""Expressions over the keys of uploaded files."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Suffixes that are let in, and the format behind each.
SUPPORTED_EXTENSIONS = (".csv", ".json", ".jsonl", ".parquet", ".gz")
FORMAT_OF_EXTENSION = {".csv": "csv", ".json": "json", ".jsonl": "json", ".parquet": "parquet"}
READER_OF_EXTENSION = {".csv": "csv", ".json": "json", ".jsonl": "jsonl", ".parquet": "parquet"}
UNKNOWN = "unknown"
# A gzipped Parquet file is no Parquet file, so only text formats are peeled.
GZIP_TEXT = (".csv", ".json", ".jsonl")

# The last dot of a name starts the extension, unless only dots stand before it.
_EXTENSION = r"(?s)^\.*[^.].*?(\.[^.]*)$"
_STRAY_PERCENT = r"%(?![0-9A-Fa-f]{2})"


def decoded_key(key: Column) -> Column:
    """URL-decoded key, ``+`` as blank; a ``%`` that starts no escape stays."""
    return F.try_url_decode(F.regexp_replace(key, _STRAY_PERCENT, "%25"))


def base_name(key: Column) -> Column:
    return F.element_at(F.split(key, "/"), -1)


def extension(key: Column) -> Column:
    """Lower-case extension with its dot, empty when there is none."""
    return F.regexp_extract(F.lower(base_name(key)), _EXTENSION, 1)


def data_extension(key: Column) -> Column:
    """The extension that tells the format: the one under ``.gz`` if zipped."""
    outer = extension(key)
    inner = F.regexp_extract(F.regexp_replace(F.lower(base_name(key)), r"\.gz$", ""), _EXTENSION, 1)
    return F.when(outer != ".gz", outer).when(inner.isin(*GZIP_TEXT), inner).otherwise("")


def _lookup(ext: Column, table: dict[str, str]) -> Column:
    chosen = F.lit(UNKNOWN)
    for suffix, value in table.items():
        chosen = F.when(ext == suffix, value).otherwise(chosen)
    return chosen


def format_of(ext: Column) -> Column:
    """csv, json, parquet or unknown, from a data extension."""
    return _lookup(ext, FORMAT_OF_EXTENSION)


def reader_of(ext: Column) -> Column:
    """Like the format, but JSON-Lines apart from JSON documents."""
    return _lookup(ext, READER_OF_EXTENSION)


def raw_key(key: Column, fmt: Column, ingest_ts: Column) -> Column:
    """``raw/{format}/year=…/month=…/day=…/{file}`` of the ingest date."""
    return F.concat(
        F.lit("raw/"),
        fmt,
        F.date_format(ingest_ts, "'/year='yyyy'/month='MM'/day='dd'/'"),
        base_name(key),
    )
