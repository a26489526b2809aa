"""Names, duplicates, types and date parts."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import UTC, datetime
from functools import reduce
from operator import and_

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clearwell.contracts import Contract, ContractError
from clearwell.functions.names import column, tidy_names
from clearwell.functions.values import DATE_CANDIDATES, DATE_PARTS, count_true, date_parts, safe_cast

COPIES = "_copies"
CAST_FAILURES = "_cast_failures"
SOURCE_FILE = "_source_file"


def normalize_names(df: DataFrame, on_collision: str = "raise") -> DataFrame:
    """Lower-case names with underscores for blanks, dashes and dots."""
    return df.toDF(*tidy_names(df.columns, on_collision))


def with_source_file(df: DataFrame) -> DataFrame:
    """Add the path a row was read from; call it right after the read."""
    return df.select("*", F.col("_metadata.file_path").alias(SOURCE_FILE))


def count_copies(df: DataFrame) -> DataFrame:
    """One row per distinct row, and how often it came, NULLs being equal.

    Copies are counted before the shuffle as well as after it, so a row that
    makes up a third of the input leaves each map task once.
    """
    return df.groupBy(*map(column, df.columns)).agg(F.count(F.lit(1)).alias(COPIES))


def deduplicate(df: DataFrame) -> DataFrame:
    """Drop exact copies, also for tables with map columns."""
    return count_copies(df).drop(COPIES)


def duplicate_count(df: DataFrame) -> DataFrame:
    """Rows before and after deduplication, in one pass."""
    return count_copies(df).agg(
        F.coalesce(F.sum(COPIES), F.lit(0)).alias("raw_count"),
        F.count(F.lit(1)).alias("distinct_count"),
        F.coalesce(F.sum(F.col(COPIES) - 1), F.lit(0)).alias("duplicate_count"),
    )


def all_null(names: Sequence[str]) -> Column:
    """True where every one of the columns is NULL."""
    return reduce(and_, [column(name).isNull() for name in names], F.lit(True))


def drop_all_null_rows(df: DataFrame) -> DataFrame:
    """Drop rows that are NULL in every column."""
    return df.dropna(how="all")


def distinct_dates(df: DataFrame) -> DataFrame:
    """The date partitions a table has rows for."""
    return df.select(*DATE_PARTS).distinct()


def union_by_name(left: DataFrame, right: DataFrame) -> DataFrame:
    """Stack two tables by column name; absent columns are NULL.

    Where one side holds text and the other a typed value, both become text, so
    that no value is lost or refused before the contract sees it.
    """
    left_types, right_types = dict(left.dtypes), dict(right.dtypes)
    mixed = {
        name
        for name in left_types.keys() & right_types.keys()
        if left_types[name] != right_types[name] and "string" in (left_types[name], right_types[name])
    }

    def as_text(df: DataFrame) -> DataFrame:
        return df.select(
            *[column(c).cast("string").alias(c) if c in mixed else column(c) for c in df.columns]
        )

    return as_text(left).unionByName(as_text(right), allowMissingColumns=True)


def apply_contract(
    df: DataFrame,
    contract: Contract,
    strict: bool = False,
    count_failures: bool = False,
) -> DataFrame:
    """Contract columns first, cast and in contract order, then the other columns.

    Nullable contract columns the input lacks become NULL. A required one stays
    absent, or raises under ``strict``. ``count_failures`` adds the number of
    values of the row that could not be cast.
    """
    types = dict(df.dtypes)
    absent = [name for name in contract.not_null if name not in types]
    if strict and absent:
        raise ContractError(f"{contract.name}: required columns are missing: {', '.join(absent)}")

    shaped: dict[str, Column] = {}
    failed: list[Column] = []
    for name, wanted in contract.columns.items():
        if name in types:
            shaped[name] = safe_cast(column(name), types[name], wanted)
            if types[name] != wanted:
                failed.append(column(name).isNotNull() & shaped[name].isNull())
        elif name not in absent:
            shaped[name] = F.lit(None).cast(wanted)
    extras = [column(name) for name in df.columns if name not in contract.columns]
    counted = [count_true(failed).alias(CAST_FAILURES)] if count_failures else []
    try:
        return df.select(*[value.alias(name) for name, value in shaped.items()], *extras, *counted)
    except AnalysisException:
        for name, value in shaped.items():
            _check_castable(df, contract, name, value)
        raise


def _check_castable(df: DataFrame, contract: Contract, name: str, value: Column) -> None:
    try:
        df.select(value)
    except AnalysisException as error:
        source = dict(df.dtypes).get(name)
        raise ContractError(
            f"{contract.name}: column {name} is {source} and cannot become {contract.columns[name]}"
        ) from error


def date_source(names: Sequence[str]) -> str | None:
    """The first well-known date column among the names."""
    return next((name for name in DATE_CANDIDATES if name in names), None)


def add_date_partitions(
    df: DataFrame,
    date_column: str | None = None,
    run_ts: datetime | None = None,
) -> DataFrame:
    """Append year, month and day as strings.

    They come from ``date_column``, else from the first well-known date column,
    else from the time of the run, one value for all rows.
    """
    chosen = date_column or date_source(df.columns)
    if chosen is None:
        moment = F.lit(run_ts or datetime.now(UTC))
    else:
        moment = moment_of(df, chosen)
    kept = [column(name) for name in df.columns if name not in DATE_PARTS]
    return df.select(*kept, *date_parts(moment))


def moment_of(df: DataFrame, name: str) -> Column:
    """A column as a point in time, NULL where it holds none."""
    kind = dict(df.dtypes)[name]
    if kind in ("timestamp", "timestamp_ntz", "date"):
        return column(name)
    return column(name).try_cast("timestamp")


def date_range(df: DataFrame, start: str, end: str) -> DataFrame:
    """Rows of the days from ``start`` to ``end`` (``yyyy-mm-dd``, both included).

    The partition strings are compared as they are, so that a partitioned table
    is pruned to the folders in question.
    """
    year, month, day = (F.col(name) for name in DATE_PARTS)

    def bound(date: str) -> tuple[str, str, str]:
        parts = tuple(date.split("-"))
        if [len(part) for part in parts] != [4, 2, 2]:
            raise ValueError(f"not a yyyy-mm-dd date: {date!r}")
        return parts

    y0, m0, d0 = bound(start)
    y1, m1, d1 = bound(end)
    from_start = (year > y0) | ((year == y0) & ((month > m0) | ((month == m0) & (day >= d0))))
    to_end = (year < y1) | ((year == y1) & ((month < m1) | ((month == m1) & (day <= d1))))
    return df.filter(year.between(y0, y1) & from_start & to_end)
