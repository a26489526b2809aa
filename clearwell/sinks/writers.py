"""Parquet sinks: partitioned by date, sized by AQE, safe to run again."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clearwell.functions.values import DATE_PARTS
from clearwell.operators.quality import ZONE
from clearwell.session import hadoop_path, planned_bytes, write_sizes

BATCH = "_batch"
# A batch of several sources has a folder for each: the id, this sign and the name of the source.
SOURCE_MARK = "@"
_ID = re.compile(r"[\w.+-]+(@[\w.+-]+)?")


def checked_id(batch_id: str) -> str:
    """A batch id that is the same as a folder name, in a path and in a pattern; others are refused."""
    if not _ID.fullmatch(batch_id):
        raise ValueError(f"a batch id has letters, digits and . _ + - only, not {batch_id!r}")
    return batch_id


def in_batch(batch_id: str) -> Column:
    """Rows of a batch, of all of its sources."""
    checked_id(batch_id)
    return (F.col(BATCH) == batch_id) | F.col(BATCH).startswith(batch_id + SOURCE_MARK)


def clustered(df: DataFrame, *keys: str) -> DataFrame:
    """Bring the rows of a folder together before the write.

    The hint lets AQE merge small folders into one task and split a large one
    over several, so a day with a third of all rows is no single task and a day
    with few rows is no heap of tiny files.
    """
    return df.hint("rebalance", *keys)


def write_partitioned(
    df: DataFrame,
    path: str,
    partitions: Sequence[str] = DATE_PARTS,
    mode: str = "append",
    max_records_per_file: int = 0,
) -> None:
    """Write by folder; ``overwrite`` replaces only the folders that get rows."""
    writer = (
        clustered(df, *partitions)
        .write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", max_records_per_file)
        .partitionBy(*partitions)
    )
    with write_sizes(df.sparkSession, planned_bytes(df)):
        writer.parquet(path)


def _of_batch(df: DataFrame, batch_id: str | None, partitions: Sequence[str]) -> tuple[DataFrame, Sequence[str]]:
    if batch_id is None:
        return df, partitions
    return df.withColumn(BATCH, F.lit(checked_id(batch_id))), (*partitions, BATCH)


def write_clean(
    df: DataFrame,
    path: str,
    mode: str = "append",
    batch_id: str | None = None,
    max_records_per_file: int = 0,
) -> None:
    """Clean rows by year, month and day.

    With a ``batch_id`` each day has a folder per batch, and ``overwrite`` replaces
    the folders of that batch only.
    """
    df, partitions = _of_batch(df, batch_id, DATE_PARTS)
    write_partitioned(df, path, partitions, mode, max_records_per_file)


def write_quarantine(
    df: DataFrame,
    path: str,
    source: str | None = None,
    mode: str = "append",
    batch_id: str | None = None,
    partitioned: bool = True,
) -> None:
    """Bad rows by source and date, or as one flat folder.

    No count comes first: without bad rows the write adds no data file.
    """
    if partitioned:
        tagged, partitions = _of_batch(df.withColumn("source", F.lit(source)), batch_id, ("source", *DATE_PARTS))
        write_partitioned(tagged, path, partitions, mode)
    else:
        df.write.mode(mode).parquet(path)


def batch_path(path: str, batch_id: str) -> str:
    return f"{path.rstrip('/')}/{BATCH}={checked_id(batch_id)}"


def drop_folders(spark: SparkSession, path: str, partitions: Sequence[str], values: Sequence[Sequence[str | None]]) -> int:
    """Delete the folders with these partition values, and no others; how many there were."""
    escaped = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    files, root = hadoop_path(spark, path)
    dropped = 0
    for row in values:
        names = ["__HIVE_DEFAULT_PARTITION__" if value is None else escaped(value) for value in row]
        folder = "/".join(f"{name}={value}" for name, value in zip(partitions, names, strict=True))
        dropped += files.delete(spark._jvm.org.apache.hadoop.fs.Path(root, folder), True)
    return dropped


def write_batch(
    marked: DataFrame,
    path: str,
    batch_id: str,
    partitions: Sequence[str] = (ZONE, *DATE_PARTS),
    max_records_per_file: int = 0,
    cluster: bool = True,
    input_bytes: int | None = None,
) -> None:
    """Write one batch into its own folder, in place of an earlier attempt.

    The whole folder is replaced: also date folders of an earlier attempt that
    this one has no rows for go away. Without ``cluster`` rows are written by the
    tasks that hold them, which suits a batch that goes to one folder.
    """
    rows = clustered(marked, *partitions) if cluster else marked
    writer = (
        rows.write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .option("maxRecordsPerFile", max_records_per_file)
        .partitionBy(*partitions)
    )
    with write_sizes(marked.sparkSession, input_bytes or planned_bytes(marked)):
        writer.parquet(batch_path(path, batch_id))


def write_report(report: DataFrame, path: str | None = None, table: str | None = None) -> None:
    """Store the result of a report as a folder or as a catalog table."""
    if (path is None) == (table is None):
        raise ValueError("name a path or a table")
    writer = report.write.mode("overwrite")
    if table:
        writer.saveAsTable(table)
    else:
        writer.parquet(path)
