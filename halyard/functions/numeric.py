"""Column expressions with exact null rules. Doubles only: a decimal literal would change the rounding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NAN = float("nan")


def snap(x: Column, step: float) -> Column:
    """x to the nearest multiple of step, halves to the even one."""
    return F.rint(x / F.lit(step)) * F.lit(step)


def mean_of_known(x: Column) -> Column:
    """The mean without nulls and NaN; NaN if nothing is left."""
    return F.coalesce(F.avg(F.when(~F.isnan(x), x)), F.lit(NAN))


def strict(aggregate, x: Column) -> Column:
    """aggregate(x), or null if any x is null. NaN stays NaN."""
    return F.when(F.count(x) == F.count(F.lit(1)), aggregate(x))


def distinct_with_null(x: Column) -> Column:
    """The exact number of distinct values; null counts as one."""
    return F.count_distinct(x) + F.max(F.when(x.isNull(), 1).otherwise(0))


def positive(x: Column) -> Column:
    """x > 0, false for NaN too, which Spark takes for the largest number."""
    return (x > 0) & ~F.isnan(x)


def micros(time: Column) -> Column:
    return F.unix_micros(time.cast("timestamp"))


def minutes(microseconds: Column) -> Column:
    return microseconds / F.lit(60_000_000.0)
