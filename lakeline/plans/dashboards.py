"""Dashboard panels over the hourly report and the fact."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import wall_seconds

# Panel columns and labels.
CITY_LABELS = (("hcmc", "HCMC"), ("hanoi", "Hanoi"), ("danang", "Danang"))
METHOD_LABELS = (
    ("MoMo", "momo_orders"), ("VNPay", "vnpay_orders"),
    ("ZaloPay", "zalopay_orders"), ("Cash", "cash_orders"),
)
MEAL_LABELS = (
    ("Lunch (11-13h)", "lunch_orders"), ("Dinner (18-20h)", "dinner_orders"),
    ("Off-peak", "off_peak_orders"),
)


def in_range(rpt: DataFrame, lo: dt.datetime, hi: dt.datetime) -> DataFrame:
    """Both bounds are local wall-clock times and inclusive."""
    bounds = [F.lit(b.isoformat(sep=" ")).cast("timestamp_ntz") for b in (lo, hi)]
    return rpt.where(F.col("hour_bucket").between(*bounds))


def orders_by_city_pivot(rpt, lo, hi, measure: str = "total_orders") -> DataFrame:
    """One row per hour, one column per city, 0 where a city has no row."""
    cities = [
        F.sum(F.when(F.col("city") == city, F.col(measure)).otherwise(F.lit(0))).alias(label)
        for city, label in CITY_LABELS
    ]
    return (
        in_range(rpt, lo, hi).groupBy(F.col("hour_bucket").alias("time")).agg(*cities)
        .orderBy("time")
    )


def totals(rpt, lo, hi) -> DataFrame:
    return in_range(rpt, lo, hi).agg(
        F.sum("total_orders").alias("total_orders"),
        F.sum("total_revenue_k_vnd").alias("total_revenue_k_vnd"),
    )


def _status(value: Column, warn: float, alert: float) -> Column:
    return (
        F.when(value.isNull(), F.lit(None).cast("string"))
        .when(value >= alert, "alert").when(value >= warn, "warn").otherwise("ok")
    )


def cancellation_rate(rpt, lo, hi, warn: float = 10, alert: float = 20) -> DataFrame:
    rate = F.round(
        F.try_divide(F.sum("cancelled_orders") * F.lit(100.0), F.sum("total_orders")), 1
    )
    return in_range(rpt, lo, hi).agg(rate.alias("value")).withColumn(
        "status", _status(F.col("value"), warn, alert)
    )


def avg_order_value(rpt, lo, hi) -> DataFrame:
    """Divides sums of already rounded hourly revenue."""
    value = F.round(F.try_divide(F.sum("total_revenue_k_vnd"), F.sum("total_orders")), 1)
    return in_range(rpt, lo, hi).agg(value.alias("value"))


def _unpivot(rpt, lo, hi, labels, name: str) -> DataFrame:
    """One aggregate over the report, then one row per label."""
    sums = in_range(rpt, lo, hi).agg(*[F.sum(c).alias(c) for _, c in labels])
    rows = F.array(*[
        F.struct(F.lit(label).alias(name), F.col(c).alias("orders")) for label, c in labels
    ])
    return sums.select(F.inline(rows))


def payment_methods(rpt, lo, hi) -> DataFrame:
    return _unpivot(rpt, lo, hi, METHOD_LABELS, "method")


def meal_periods(rpt, lo, hi) -> DataFrame:
    return _unpivot(rpt, lo, hi, MEAL_LABELS, "period")


def freshness(fct: DataFrame, as_of: dt.datetime, warn: int = 60, alert: int = 300) -> DataFrame:
    """Seconds since the newest order, seen from local time ``as_of``.

    Only yesterday's and today's partitions are read.
    """
    recent = fct.where(F.col("placed_date") >= F.lit(as_of.date() - dt.timedelta(days=1)))
    now = F.lit(as_of.isoformat(sep=" ")).cast("timestamp_ntz")
    stale = wall_seconds(now) - wall_seconds(
        F.max("placed_at_local")
    )
    return recent.agg(stale.alias("seconds_stale")).withColumn(
        "status", _status(F.col("seconds_stale"), warn, alert)
    )
