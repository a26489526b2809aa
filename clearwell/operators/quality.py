"""Row rules, the first-failure reason, the split and its metrics."""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clearwell.functions.names import column
from clearwell.operators.shape import CAST_FAILURES, COPIES

log = logging.getLogger(__name__)

REASON = "_quarantine_reason"
ZONE = "_zone"
CLEAN, QUARANTINE, BLANK = "clean", "quarantine", "blank"

# Fixed value: a run below this pass rate is reported as a warning.
PASS_RATE_ALERT = 80.0


def failure_reason(
    names: Sequence[str],
    not_null: Sequence[str],
    positive: Sequence[str] = (),
) -> Column:
    """Label of the first rule a row breaks, NULL for a good row.

    Not-null rules come before positive rules, each in the order given; rules on
    columns outside ``names`` are skipped. A NULL breaks no positive rule, so the
    label is either set or not and every row falls on exactly one side.
    """
    labels = [F.when(column(c).isNull(), f"null:{c}") for c in not_null if c in names]
    labels += [F.when(column(c) <= 0, f"non_positive:{c}") for c in positive if c in names]
    return F.coalesce(*labels, F.lit(None).cast("string"))


def mark_failures(df: DataFrame, not_null: Sequence[str], positive: Sequence[str] = ()) -> DataFrame:
    return df.withColumn(REASON, failure_reason(df.columns, not_null, positive))


def split_quarantine(
    df: DataFrame,
    not_null: Sequence[str],
    positive: Sequence[str] = (),
) -> tuple[DataFrame, DataFrame]:
    """Good rows, and bad rows with the reason."""
    marked = mark_failures(df, not_null, positive)
    reason = F.col(REASON)
    return marked.filter(reason.isNull()).drop(REASON), marked.filter(reason.isNotNull())


def reason_histogram(quarantine: DataFrame) -> DataFrame:
    return quarantine.groupBy(REASON).agg(F.count(F.lit(1)).alias("count"))


def _rate(clean: Column, raw: Column) -> Column:
    """Percent with two digits, a tie going to the even digit; 0 for no rows."""
    return F.when(raw > 0, F.bround(clean.cast("double") / raw * 100, 2)).otherwise(F.lit(0.0))


def _with_verdict(counts: DataFrame) -> DataFrame:
    return counts.withColumn("pass_rate_pct", _rate(F.col("clean_count"), F.col("raw_count"))).withColumn(
        "below_threshold", F.col("pass_rate_pct") < PASS_RATE_ALERT
    )


def quality_metrics(marked: DataFrame) -> DataFrame:
    """One row of counts and the pass rate, in one pass over marked rows (``mark_failures``)."""
    good = F.col(REASON).isNull()
    return _with_verdict(
        marked.agg(
            F.count(F.lit(1)).alias("raw_count"),
            F.count_if(good).alias("clean_count"),
            F.count_if(~good).alias("quarantine_count"),
        )
    )


def frame_metrics(raw: DataFrame, clean: DataFrame, quarantine: DataFrame) -> DataFrame:
    """The same row for three frames that have no marks in common, in one job.

    Each frame is computed for its count; ``raw`` may hold more rows than the
    other two together, such as duplicates.
    """
    parts = {"raw": raw, CLEAN: clean, QUARANTINE: quarantine}
    # One row per frame is all that the last aggregation sees.
    counted = [df.agg(F.count(F.lit(1)).alias("n")).withColumn("part", F.lit(name)) for name, df in parts.items()]
    stacked = counted[0].unionByName(counted[1]).unionByName(counted[2])
    return _with_verdict(
        stacked.agg(
            *[
                F.sum(F.when(F.col("part") == name, F.col("n")).otherwise(0)).alias(f"{name}_count")
                for name in parts
            ]
        )
    )


def zone_metrics(marked: DataFrame) -> DataFrame:
    """Quality metrics of a marked batch (``plans.batch.mark_batch``).

    Every count follows from the copies each distinct row stands for, so the
    numbers are exact however often a task of the batch had to run again.
    """
    zone = F.col(ZONE)

    def rows(which: str) -> Column:
        return F.count_if(zone == which)

    def total(value: Column) -> Column:
        return F.coalesce(F.sum(value), F.lit(0))

    counts = marked.agg(
        total(F.col(COPIES)).alias("raw_count"),
        rows(CLEAN).alias("clean_count"),
        rows(QUARANTINE).alias("quarantine_count"),
        total(F.col(COPIES) - 1).alias("duplicate_count"),
        rows(BLANK).alias("all_null_count"),
        total(F.col(CAST_FAILURES)).alias("cast_failure_count"),
    )
    return _with_verdict(counts)


def log_verdict(table: str, metrics: dict) -> None:
    """One log line per run, a warning below the alert line."""
    if metrics["below_threshold"]:
        log.warning(
            "%s: pass rate %.2f%% is below %.0f%%, see the quarantine rows",
            table,
            metrics["pass_rate_pct"],
            PASS_RATE_ALERT,
        )
    else:
        log.info("%s: %s", table, metrics)


def profile(df: DataFrame, names: Sequence[str] | None = None, exact: bool = False) -> DataFrame:
    """Completeness and uniqueness of each column, from one pass.

    Distinct values are estimated unless ``exact``, which multiplies the shuffled
    rows by the number of columns.
    """
    names = list(names or df.columns)
    distinct = F.count_distinct if exact else F.approx_count_distinct
    measured = df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[
            F.struct(F.count(column(c)).alias("filled"), distinct(column(c)).alias("distinct")).alias(f"c{i}")
            for i, c in enumerate(names)
        ],
    )
    entries = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.col("rows").alias("row_count"),
            F.col(f"c{i}.filled").alias("filled_count"),
            F.col(f"c{i}.distinct").alias("distinct_count"),
        )
        for i, c in enumerate(names)
    ]
    share = F.col("row_count").cast("double")
    return measured.select(F.inline(F.array(*entries))).select(
        "*",
        F.when(share > 0, F.col("filled_count") / share).alias("completeness"),
        F.when(F.col("filled_count") > 0, F.col("distinct_count") / F.col("filled_count").cast("double")).alias(
            "uniqueness"
        ),
    )
