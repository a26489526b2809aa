"""Results kept up to date batch by batch: what a batch adds is stored, and only what it touches is computed again.

Each result keeps *partials*, a folder for each batch, and a note for each batch whose partials are done.
A batch that was written again since, or is gone, is taken back and done anew. Before partials change, the
months they had rows in are written down as open, until the result of these months is there: a run that ends
at any point leaves work for the next one, and never a wrong sum for good. Batches that a compaction moved
are known by their id and cost nothing. Like batches, calls for one table run one after another.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from urllib.parse import quote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from clearwell.contracts import ORDERS, Contract
from clearwell.functions.names import column
from clearwell.functions.values import merged_sum, sum_parts
from clearwell.operators.quality import CLEAN, ZONE
from clearwell.plans.batch import marked_rows, table_path
from clearwell.plans.reports import not_cancelled
from clearwell.session import hadoop_path, pin
from clearwell.sinks.compaction import live_batches, state_of
from clearwell.sinks.manifest import read_json, write_json
from clearwell.sinks.writers import BATCH, batch_path, clustered, drop_folders

MONTH = ("year", "month")


@dataclass(frozen=True)
class Kept:
    """A result over the batches of a table, under a name; ``settings`` are what its partials depend on."""

    lake: str
    contract: Contract
    name: str
    settings: str = ""

    @property
    def folder(self) -> str:
        return f"{self.lake.rstrip('/')}/kept_results/{quote(self.contract.name, safe='')}/{quote(self.name, safe='')}"

    @property
    def partials(self) -> str:
        return f"{self.folder}/partials"

    @property
    def result(self) -> str:
        return f"{self.folder}/result"

    def changed(self, spark: SparkSession) -> dict[str, str | None]:
        """Batches that are new or other than noted, with the time of their last write; None for one that is gone."""
        noted = {row["batch"]: row for row in read_json(spark, f"{self.folder}/done")}
        if any(row["settings"] != self.settings for row in noted.values()):
            raise ValueError(f"{self.name} is kept with other settings; choose another name")
        path = table_path(self.lake, self.contract.name)
        state = state_of(spark, self.lake, self.contract.name)
        found = {id_: _written(spark, batch_path(path, id_)) for id_ in live_batches(spark, path) if id_ not in state.taken}
        # What is in a run was written before, whenever that was.
        found |= {id_: noted[id_]["written"] if id_ in noted else "" for id_ in state.batches}
        new = {id_: at for id_, at in found.items() if id_ not in noted or noted[id_]["written"] != at}
        return new | dict.fromkeys(noted.keys() - found.keys())

    def done(self, spark: SparkSession, batches: dict[str, str | None]) -> None:
        for id_, written in batches.items():
            path = f"{self.folder}/done/{quote(id_, safe='')}.json"
            if written is None:
                _delete(spark, path)
            else:
                write_json(spark, path, [{"batch": id_, "written": written, "settings": self.settings}])

    def store_partials(self, spark: SparkSession, rows: DataFrame | None, batches: Sequence[str], by: Sequence[str]) -> None:
        """Put ``rows`` in place of what these batches had."""
        drop_folders(spark, self.partials, (BATCH,), [(id_,) for id_ in batches])
        if rows is not None:
            clustered(rows, BATCH, *by).write.mode("append").partitionBy(BATCH, *by).parquet(self.partials)

    def read_partials(self, spark: SparkSession, schema: StructType, batches: Sequence[str] | None = None) -> DataFrame | None:
        """All partials or those of some batches, whose folders are then all that is listed; None if there are none."""
        paths = [self.partials] if batches is None else [batch_path(self.partials, id_) for id_ in batches]
        paths = [path for path in paths if _exists(spark, path)]
        return spark.read.schema(schema).option("basePath", self.partials).parquet(*paths) if paths else None


def _exists(spark: SparkSession, path: str) -> bool:
    files, target = hadoop_path(spark, path)
    return files.exists(target)


def _delete(spark: SparkSession, path: str) -> None:
    files, target = hadoop_path(spark, path)
    files.delete(target, True)


def _written(spark: SparkSession, folder: str) -> str:
    """When a batch was last written as a whole."""
    files, success = hadoop_path(spark, f"{folder}/_SUCCESS")
    if not files.exists(success):
        files, success = hadoop_path(spark, folder)
    return str(files.getFileStatus(success).getModificationTime())


# Daily revenue.

_REVENUE = "total_orders bigint, daily_revenue double, avg_order_value double, unique_customers bigint"


def _month_in(months: Sequence[tuple[str | None, str | None]]) -> Column:
    """Rows of these months, by their folders alone."""
    known = [f"{year}-{month}" for year, month in months if year is not None]
    some = F.concat_ws("-", *MONTH).isin(known) if known else F.lit(False)
    return some | F.col("year").isNull() if len(known) < len(months) else some


def refresh_daily_revenue(
    spark: SparkSession, lake: str, contract: Contract = ORDERS, cancelled: str = "cancelled", digits: int = 2
) -> list[tuple[str | None, str | None]]:
    """Bring the stored ``reports.daily_revenue`` up to date; the months that were computed again.

    A partial is what one batch brought for a customer and day: customers of a day can be told apart
    and sums are exact, so the merged report is that of all clean rows at once. Work follows
    the new batches and the partials of the months they have rows in.
    """
    pin(spark)
    kept = Kept(lake, contract, "daily_revenue", f"{cancelled}/{digits}")
    changed = kept.changed(spark)
    sums = "orders bigint, amounts bigint, high bigint, low bigint, other double"
    schema = StructType.fromDDL(f"day string, customer_id string, {sums}, `{BATCH}` string, year string, month string")
    if changed:
        before = kept.read_partials(spark, schema, list(changed))
        rows = _customer_days(spark, kept, [id_ for id_, at in changed.items() if at is not None], cancelled, digits)
        _open_months(spark, kept, before)
        kept.store_partials(spark, rows, list(changed), MONTH)
        _open_months(spark, kept, kept.read_partials(spark, schema, list(changed)))
        kept.done(spark, changed)
    opened = read_json(spark, f"{kept.folder}/open")
    months = sorted({(row["year"], row["month"]) for row in opened}, key=str)
    if months:
        partials = kept.read_partials(spark, schema)
        if partials is not None:
            _write_months(partials.where(_month_in(months)), kept, digits)
        # A month without any row left has no folder.
        there = set() if partials is None else set(map(tuple, partials.where(_month_in(months)).select(*MONTH).distinct().collect()))
        drop_folders(spark, kept.result, MONTH, [month for month in months if month not in there])
    for name in {row["file"] for row in opened}:
        _delete(spark, f"{kept.folder}/open/{name}")
    return months


def _customer_days(spark: SparkSession, kept: Kept, batches: list[str], cancelled: str, digits: int) -> DataFrame | None:
    if not batches:
        return None
    clean = marked_rows(spark, kept.lake, kept.contract, "", batches).where(F.col(ZONE) == CLEAN)
    high, low, other = sum_parts(F.col("total_amount"), digits)
    return (
        not_cancelled(clean, cancelled)
        .groupBy("day", "customer_id", BATCH, *MONTH)
        .agg(
            F.count(F.lit(1)).alias("orders"),
            F.count("total_amount").alias("amounts"),
            F.sum(high).alias("high"),
            F.sum(low).alias("low"),
            F.sum(other).alias("other"),
        )
    )


def _open_months(spark: SparkSession, kept: Kept, partials: DataFrame | None) -> None:
    if partials is not None:
        months = [row.asDict() for row in partials.select(*MONTH).distinct().collect()]
        if months:
            write_json(spark, f"{kept.folder}/open/{uuid.uuid4().hex}.json", months)


def _write_months(partials: DataFrame, kept: Kept, digits: int) -> None:
    days = partials.groupBy(*MONTH, "day").agg(
        F.sum("orders").alias("total_orders"),
        merged_sum(F.col("high"), F.col("low"), F.col("other"), digits).alias("daily_revenue"),
        F.sum("amounts").alias("amounts"),
        F.count_distinct("customer_id").alias("unique_customers"),
    )
    average = F.try_divide(F.col("daily_revenue"), F.col("amounts").cast("double")).alias("avg_order_value")
    days = days.select("day", "total_orders", "daily_revenue", average, "unique_customers", *MONTH)
    writer = clustered(days, *MONTH).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*MONTH).parquet(kept.result)


def kept_daily_revenue(spark: SparkSession, lake: str, contract: Contract = ORDERS) -> DataFrame:
    """The stored report as of the last ``refresh_daily_revenue``; no rows before the first."""
    kept = Kept(lake, contract, "daily_revenue")
    schema = f"day string, {_REVENUE}, year string, month string"
    stored = _exists(spark, kept.result)
    rows = spark.read.schema(schema).parquet(kept.result) if stored else spark.createDataFrame([], schema)
    names = [name.split()[0] for name in _REVENUE.split(", ")]
    return rows.select(*MONTH, "day", *names).orderBy(*MONTH, "day")


# Profiles.

# Relative standard error of a distinct count is 1.04 / sqrt(2 ** LG_K), rank error of a quantile about 1.33 %.
LG_K = 14
KLL_K = 200
_QUANTILES = (0.05, 0.25, 0.5, 0.75, 0.95)
_SKETCHES = "column_name string, row_count bigint, filled_count bigint, distinct binary, numbers binary"


def refresh_profile(spark: SparkSession, lake: str, contract: Contract) -> list[str]:
    """Store sketches of the clean rows of each new or changed batch; the batches that were read.

    For each column of the contract: rows, values, an HLL sketch of the distinct ones and, for numbers, a KLL
    sketch. A batch is read once, in one pass with map-side combining, and never again.
    """
    pin(spark)
    kept = Kept(lake, contract, "profile", f"{LG_K}/{KLL_K}")
    changed = kept.changed(spark)
    there = [id_ for id_, at in changed.items() if at is not None]
    kept.store_partials(spark, _batch_sketches(spark, kept, there) if there else None, list(changed), ())
    kept.done(spark, changed)
    return sorted(there)


def _batch_sketches(spark: SparkSession, kept: Kept, batches: list[str]) -> DataFrame:
    clean = marked_rows(spark, kept.lake, kept.contract, "", batches).where(F.col(ZONE) == CLEAN)
    kinds = dict(clean.dtypes)
    measures, entries = [F.count(F.lit(1)).alias("rows")], []
    for i, name in enumerate(kept.contract.columns):
        value = column(name)
        number = kinds[name] in ("double", "float", "int", "bigint", "smallint", "tinyint") or kinds[name].startswith("decimal")
        measures += [F.count(value).alias(f"f{i}"), F.hll_sketch_agg(value.cast("string"), LG_K).alias(f"d{i}")]
        if number:
            measures.append(F.kll_sketch_agg_double(_finite(value), KLL_K).alias(f"n{i}"))
        entries.append(
            F.struct(
                F.lit(name).alias("column_name"),
                F.col("rows").alias("row_count"),
                F.col(f"f{i}").alias("filled_count"),
                F.col(f"d{i}").alias("distinct"),
                (F.col(f"n{i}") if number else F.lit(None).cast("binary")).alias("numbers"),
            )
        )
    return clean.groupBy(BATCH).agg(*measures).select(F.inline(F.array(*entries)), BATCH)


def _finite(value: Column) -> Column:
    number = value.cast("double")
    return F.when(F.abs(number) < float("inf"), number)


def kept_profile(spark: SparkSession, lake: str, contract: Contract) -> DataFrame:
    """Rows, values, distinct values and quantiles of each column over all batches, from stored sketches alone.

    ``quantiles`` are those at 5, 25, 50, 75 and 95 per cent, null for columns without numbers. Distinct counts are
    within 4 per cent with five standard errors, ranks of quantiles within 3 per cent.
    """
    kept = Kept(lake, contract, "profile")
    schema = StructType.fromDDL(f"{_SKETCHES}, `{BATCH}` string")
    rows = kept.read_partials(spark, schema)
    rows = spark.createDataFrame([], schema) if rows is None else rows
    merged = rows.groupBy("column_name").agg(
        F.sum("row_count").alias("row_count"),
        F.sum("filled_count").alias("filled_count"),
        F.hll_sketch_estimate(F.hll_union_agg("distinct")).alias("distinct_count"),
        F.kll_merge_agg_double("numbers").alias("numbers"),
    )
    ranks = F.array(*map(F.lit, _QUANTILES))
    some = F.col("numbers").isNotNull() & (F.kll_sketch_get_n_double("numbers") > 0)
    quantiles = F.when(some, F.kll_sketch_get_quantile_double("numbers", ranks)).alias("quantiles")
    return merged.select("column_name", "row_count", "filled_count", "distinct_count", quantiles)
