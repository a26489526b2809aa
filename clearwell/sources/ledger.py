"""Which files were taken, when they were last changed, and which could not be read.

The ledger is kept beside the tables, so it outlives any checkpoint: a file that a renewed checkpoint
offers again is recognised by path, length and time of change. Notes lie in a folder for each day of
change; a micro-batch looks at the days of its own files only, however long the history is.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import UTC, datetime
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession

from clearwell.session import hadoop_path
from clearwell.sinks.manifest import write_json

TAKEN_FILES = "taken_files"
_NOTE = "path string, length bigint, modified bigint, batch string, feed string, fault string"


@dataclass(frozen=True)
class LandedFile:
    path: str
    length: int
    modified: int  # milliseconds since 1970

    @property
    def day(self) -> str:
        return datetime.fromtimestamp(self.modified / 1000, UTC).strftime("%Y-%m-%d")


@dataclass(frozen=True)
class Ledger:
    lake: str
    feed: str

    @property
    def folder(self) -> str:
        return f"{self.lake.rstrip('/')}/{TAKEN_FILES}/{quote(self.feed, safe='')}"

    def not_taken(self, spark: SparkSession, files: Sequence[LandedFile], batch: str) -> list[LandedFile]:
        """The files that no other batch of the feed took; a batch that is run again may take its own once more."""
        days = sorted({f"{self.folder}/{file.day}" for file in files})
        days = [day for day in days if _exists(spark, day)]
        if not days:
            return list(files)
        taken = spark.read.schema(_NOTE).json(days).where("fault IS NULL").where(f"batch <> '{batch}'")
        offered = spark.createDataFrame(
            [(file.path, file.length, file.modified) for file in files], "path string, length bigint, modified bigint"
        )
        fresh = offered.join(taken, ["path", "length", "modified"], "left_anti")
        return [LandedFile(*row) for row in sorted(map(tuple, fresh.collect()))]

    def note(self, spark: SparkSession, files: Sequence[LandedFile], batch: str, faults: dict[str, str]) -> None:
        """Write down the files of a batch that is done, with what is wrong with those set apart."""
        for day in sorted({file.day for file in files}):
            rows = [
                {
                    "path": file.path,
                    "length": file.length,
                    "modified": file.modified,
                    "batch": batch,
                    "feed": self.feed,
                    "fault": faults.get(file.path),
                }
                for file in files
                if file.day == day
            ]
            write_json(spark, f"{self.folder}/{day}/{quote(batch, safe='')}.json", rows)


def _exists(spark: SparkSession, path: str) -> bool:
    files, target = hadoop_path(spark, path)
    return files.exists(target)


def taken_files(spark: SparkSession, lake: str) -> DataFrame:
    """All notes: path, length, time of change in milliseconds, batch, feed, and the fault of a file set apart."""
    folder = f"{lake.rstrip('/')}/{TAKEN_FILES}"
    if not _exists(spark, folder):
        return spark.createDataFrame([], _NOTE)
    return spark.read.schema(_NOTE).option("recursiveFileLookup", True).json(folder)


def unreadable_files(spark: SparkSession, lake: str) -> DataFrame:
    """Files set apart, with the fault found last; a file that was read later is none of them."""
    notes = taken_files(spark, lake)
    key = ["path", "length", "modified", "feed"]
    read = notes.where("fault IS NULL").select(*key)
    return notes.where("fault IS NOT NULL").join(read, key, "left_anti")
