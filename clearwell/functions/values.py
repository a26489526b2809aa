"""ANSI-safe casts, date parts and exact sums."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal
from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

_INTEGERS = {"tinyint", "smallint", "int", "integer", "bigint", "long"}

# Columns that may date a row, first present one wins.
DATE_CANDIDATES = ("created_at", "timestamp", "event_time", "date", "updated_at")
DATE_PARTS = ("year", "month", "day")

_LOW_BITS = 20


def safe_cast(value: Column, from_type: str, to_type: str) -> Column:
    """Cast that yields NULL for a bad value instead of failing the job.

    Text such as ``"2.0"`` still becomes an integer, as it does when the type is
    inferred first and cast afterwards.
    """
    if from_type == to_type:
        return value
    cast = value.try_cast(to_type)
    if from_type == "string" and to_type in _INTEGERS:
        return F.coalesce(cast, value.try_cast("double").try_cast(to_type))
    return cast


def count_true(flags: Sequence[Column]) -> Column:
    """How many of the flags hold, as an int."""
    return reduce(add, [flag.cast("int") for flag in flags], F.lit(0))


def date_parts(moment: Column) -> list[Column]:
    """year, month, day as strings, month and day with two digits."""
    return [
        F.year(moment).cast("string").alias("year"),
        F.lpad(F.month(moment).cast("string"), 2, "0").alias("month"),
        F.lpad(F.dayofmonth(moment).cast("string"), 2, "0").alias("day"),
    ]


def exact_sum(amount: Column, digits: int | None = None) -> Column:
    """Sum of doubles as they come or, with ``digits``, exact to so many decimal places.

    An exact sum is the same for any order of the rows. Amounts become whole units,
    whose low bits and remaining bits are added up apart: two sums of plain integers,
    several times faster than a decimal sum, with room for trillions of rows. Amounts
    that are too large for whole units, and those that are not finite, are added up as
    doubles beside them. The result is a double, NULL without amounts.
    """
    if digits is None:
        return F.sum(amount.cast("double"))
    return merged_sum(*sum_parts(amount, digits), digits)


def sum_parts(amount: Column, digits: int) -> tuple[Column, Column, Column]:
    """Three columns of each amount whose plain sums can be stored, added up again and merged to the exact sum.

    The high and the low bits of whole units, and amounts that are none.
    """
    value = amount.cast("double")
    scale = float(10**digits)
    # NaN is above every number.
    fits = F.abs(value) < 2.0**62 / scale
    units = F.rint(F.when(fits, value) * scale).cast("bigint")
    return F.shiftright(units, _LOW_BITS), units.bitwiseAND(F.lit(2**_LOW_BITS - 1)), F.when(~fits, value)


def merged_sum(high: Column, low: Column, other: Column, digits: int) -> Column:
    """The sum of amounts from their ``sum_parts``, or from sums of these."""
    highs = F.sum(high).cast("decimal(20,0)")
    lows = F.sum(low).cast("decimal(20,0)")
    whole = highs * F.lit(2**_LOW_BITS).cast("decimal(7,0)") + lows
    exact = (whole * F.lit(Decimal(1).scaleb(-digits))).cast("double")
    others = F.sum(other)
    return F.coalesce(exact + others, exact, others)
