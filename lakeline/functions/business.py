"""Derived business columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .timestamps import wall_seconds


def meal_period(hour: Column | str) -> Column:
    """Both ranges include their last hour."""
    h = F.col(hour) if isinstance(hour, str) else hour
    return (
        F.when(h.between(11, 13), "lunch").when(h.between(18, 20), "dinner").otherwise("off_peak")
    )


def flag(condition: Column) -> Column:
    """1 when true, 0 when false or unknown."""
    return F.when(condition, 1).otherwise(0)


def positive_delay_seconds(start: Column, end: Column, wall_clock: bool = False) -> Column:
    """Whole-second difference of two instants, or of two wall clocks of one zone, floored at 0;
    NULL when either side is missing.

    Each side is cut to its second before subtracting. ``greatest`` skips NULLs
    in Spark, hence the explicit guard.
    """
    seconds = wall_seconds if wall_clock else F.unix_timestamp
    delay = seconds(end) - seconds(start)
    return F.when(delay.isNotNull(), F.greatest(F.lit(0).cast("bigint"), delay))
