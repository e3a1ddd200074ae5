"""Marts: order fact, restaurant and rider dimensions, hourly revenue report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import flag, hour_bucket


METHOD_COLUMNS = ("momo", "vnpay", "zalopay", "cash")
MEAL_COLUMNS = ("lunch", "dinner", "off_peak")


def _count_status(status: str) -> Column:
    return F.count_if(F.col("order_status") == status)


def fct_orders(order_payments: DataFrame) -> DataFrame:
    return order_payments.withColumns({
        "is_cancelled": flag(F.col("order_status") == "cancelled"),
        "is_delivered": flag(F.col("order_status") == "delivered"),
        "is_paid": flag(F.col("payment_status") == "success"),
    })


def dim_restaurant(fct: DataFrame) -> DataFrame:
    cancelled = _count_status("cancelled")
    return fct.groupBy("restaurant_id", "city").agg(
        F.count("*").alias("total_orders"),
        F.sum("total_vnd").alias("total_revenue_vnd"),
        F.round(F.avg("total_vnd")).alias("avg_order_vnd"),
        _count_status("delivered").alias("delivered_orders"),
        cancelled.alias("cancelled_orders"),
        F.round(cancelled * F.lit(100.0) / F.count("*"), 1).alias("cancellation_rate_pct"),
        F.min("placed_date").alias("first_order_date"),
        F.max("placed_date").alias("last_order_date"),
    )


def dim_rider(delivery_metrics: DataFrame) -> DataFrame:
    """Averages are unweighted averages of the daily values.

    They are taken over decimals: sums of doubles depend on the order of the
    rows, and a value near a rounding boundary would change between runs.
    The input has one row per rider, city and day, so counting its days is the
    distinct count, without a distinct aggregate.
    """
    def mean(column: str, digits: int) -> Column:
        exact = F.avg(F.col(column).cast("decimal(20,10)"))
        return F.round(exact, digits).cast("double")

    return delivery_metrics.groupBy("rider_id", "city").agg(
        F.sum("total_pings").alias("lifetime_pings"),
        mean("utilization_pct", 1).alias("avg_utilization_pct"),
        mean("avg_speed_kmh", 1).alias("avg_speed_kmh"),
        mean("avg_battery_pct", 0).alias("avg_battery_pct"),
        F.count("event_date").alias("active_days"),
    )


def rpt_hourly_revenue(fct: DataFrame) -> DataFrame:
    methods = [
        F.count_if(F.col("payment_method") == m).alias(f"{m}_orders") for m in METHOD_COLUMNS
    ]
    meals = [F.count_if(F.col("meal_period") == m).alias(f"{m}_orders") for m in MEAL_COLUMNS]
    revenue = F.sum("total_vnd")
    return fct.groupBy("city", hour_bucket("placed_at_local").alias("hour_bucket")).agg(
        F.count("*").alias("total_orders"),
        _count_status("delivered").alias("delivered_orders"),
        _count_status("cancelled").alias("cancelled_orders"),
        revenue.alias("total_revenue_vnd"),
        F.round(revenue / F.lit(1000.0)).alias("total_revenue_k_vnd"),
        F.round(F.avg("total_vnd")).alias("avg_order_vnd"),
        *methods,
        *meals,
    )
