"""Databases and tables over folders of the lake."""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from clearwell.functions.values import DATE_PARTS
from clearwell.sources.readers import list_uploads

log = logging.getLogger(__name__)


def database_name(project: str, environment: str) -> str:
    return f"{project}_{environment}_db".replace("-", "_")


def ensure_database(spark: SparkSession, name: str, location: str | None = None) -> str:
    place = f" LOCATION '{_escaped(location)}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`{place}")
    return name


def register_table(
    spark: SparkSession,
    table: str,
    path: str,
    schema: str,
    partitions: Sequence[str] = DATE_PARTS,
    recover: bool = True,
) -> None:
    """Define a table over a partitioned Parquet folder and, with ``recover``, pick up all of its folders.

    ``schema`` lists the data columns; partition columns are strings. A table that
    exists gets the columns of ``schema`` it lacks.
    """
    folder_columns = ", ".join(f"`{name}` string" for name in partitions)
    by = ", ".join(f"`{name}`" for name in partitions)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({schema}, {folder_columns}) USING parquet"
        f" PARTITIONED BY ({by}) LOCATION '{_escaped(path)}'"
    )
    add_columns(spark, table, [(f.name, f.dataType.simpleString()) for f in StructType.fromDDL(schema)])
    if recover:
        spark.catalog.recoverPartitions(table)


def add_partitions(
    spark: SparkSession, table: str, partitions: Sequence[str], values: Sequence[Sequence[str | None]], at_once: int = 200
) -> None:
    """Define these partitions where they are not yet; no folder is listed."""
    specs = [
        ", ".join(
            f"`{name}`='{_escaped('__HIVE_DEFAULT_PARTITION__' if value is None else value)}'"
            for name, value in zip(partitions, row, strict=True)
        )
        for row in values
    ]
    for at in range(0, len(specs), at_once):
        added = " ".join(f"PARTITION ({spec})" for spec in specs[at : at + at_once])
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {added}")


def refresh_table(spark: SparkSession, table: str, seen: DataFrame | None = None) -> None:
    """Pick up new partition folders.

    Partitions whose folder is gone stay defined and are logged when ``seen``,
    the folders of the lake, is given.
    """
    spark.catalog.recoverPartitions(table)
    spark.catalog.refreshTable(table)
    if seen is not None:
        gone = stale_partitions(spark, table, seen).count()
        if gone:
            log.warning("%s: %d partitions have no files any more", table, gone)


def partition_folders(spark: SparkSession, path: str, partitions: Sequence[str] = DATE_PARTS) -> DataFrame:
    """The partitions that have files, as ``a=1/b=2`` strings, from a listing alone."""
    files = list_uploads(spark, path).select(F.col("original_key").alias("file"))
    folders = "/".join(f"{name}=[^/]+" for name in partitions)
    return files.select(F.regexp_extract("file", f"({folders})/[^/]+$", 1).alias("partition")).distinct()


def stale_partitions(spark: SparkSession, table: str, seen: DataFrame) -> DataFrame:
    """Defined partitions that have no files."""
    return spark.sql(f"SHOW PARTITIONS {table}").join(seen, "partition", "left_anti")


def add_columns(spark: SparkSession, table: str, columns: Sequence[tuple[str, str]]) -> list[str]:
    """Add the (name, type) pairs the table lacks, such as ``df.dtypes``; existing columns stay as they are."""
    known = {name.lower() for name in spark.table(table).columns}
    new = [(name, kind) for name, kind in columns if name.lower() not in known]
    if new:
        listed = ", ".join(f"`{name}` {kind}" for name, kind in new)
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({listed})")
    return [name for name, _ in new]


def _escaped(text: str) -> str:
    return text.replace("\\", "\\\\").replace("'", "\\'")
