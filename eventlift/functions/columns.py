"""Column helpers; all stay inside whole-stage code generation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_n(value: Column, digits: int) -> Column:
    """Round a double by scaling.

    Spark's own ``round(x, n)`` works on the decimal text of the double and so
    turns 1.005 into 1.01; the warehouse the marts came from scales, rounds and
    scales back.  This does the latter.
    """
    scale = float(10**digits)
    return F.round(value.cast("double") * F.lit(scale), 0) / F.lit(scale)


def ratio(numerator: Column, denominator: Column) -> Column:
    """``numerator / denominator`` as double; NULL for a zero or NULL denominator."""
    return numerator.cast("double") / F.nullif(denominator.cast("double"), F.lit(0.0))


def percent(numerator: Column, denominator: Column) -> Column:
    return ratio(numerator, denominator) * F.lit(100.0)


def sum_if(condition: Column, value: Column) -> Column:
    """Sum of ``value`` over rows meeting ``condition``; 0 when none does."""
    return F.sum(F.when(condition, value).otherwise(F.lit(0)))


def count_if(condition: Column) -> Column:
    """Rows meeting ``condition``, as bigint and never NULL."""
    return F.sum(F.when(condition, F.lit(1)).otherwise(F.lit(0)))


def iso_utc(moment: Column) -> Column:
    """A timestamp as ISO text in UTC, whatever the session's zone."""
    return F.date_format(F.to_utc_timestamp(moment, F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
