"""Queries over the test tables and the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from clearwell.session import folder_bytes, pin, shared_folder, widen_shuffles

_sized: dict[tuple[str, str], int] = {}


class Tables:
    """The test tables in one folder."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = pin(spark)
        self.folder = folder.rstrip("/")
        self._size_shuffles()

    def __getitem__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def scratch(self, label: str) -> str:
        return shared_folder(self.spark, label)

    def _size_shuffles(self) -> None:
        # One listing per session and folder tells how much a shuffle may carry.
        key = (self.spark.sparkContext.applicationId, self.folder)
        if key not in _sized:
            _sized[key] = folder_bytes(self.spark, self.folder)
        widen_shuffles(self.spark, _sized[key])


@dataclass(frozen=True)
class Query:
    run: Callable[[Tables], DataFrame]
    sql: str | None = None


REGISTRY: dict[str, Query] = {}


def query(sql: str | None = None) -> Callable:
    """Register a function of ``Tables`` under its own name."""

    def register(run: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        if run.__name__ in REGISTRY:
            raise ValueError(f"query {run.__name__} is registered twice")
        REGISTRY[run.__name__] = Query(run, sql)
        return run

    return register
