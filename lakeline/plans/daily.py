"""Daily city summary over the UTC day of the event."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import positive_delay_seconds, utc_datetime
from ..operators.dedup import latest_by
from ..operators.joins import left_join
from .staging import ORDER_TIES, PAYMENT_TIES, _ties

SUMMARY_KEYS = ("batch_date", "city", "payment_method", "platform")


def daily_summary(
    orders_day: DataFrame,
    payments_day: DataFrame,
    batch_date: str | dt.date,
    processed_at: Column | None = None,
    hot_orders: DataFrame | None = None,
) -> DataFrame:
    """Summary of one day. Payments of another day count as missing.

    Statuses are compared as stored, and an unpaid order counts as delay 0.
    """
    orders = latest_by(orders_day, ["order_id"], "event_timestamp", _ties(orders_day, ORDER_TIES))
    payments = latest_by(
        payments_day, ["payment_id"], "event_timestamp", _ties(payments_day, PAYMENT_TIES)
    )
    right = payments.select("order_id", "processed_at", F.col("status").alias("payment_status"))
    joined = left_join(
        orders.select("order_id", "city", "payment_method", "platform", "status",
                      "total_vnd", "placed_at"),
        right, "order_id", hot_orders,
    )
    day = F.lit(batch_date).cast("date")
    return _summarise(joined.withColumn("batch_date", day), processed_at)


def daily_summary_backfill(
    orders: DataFrame,
    payments: DataFrame,
    processed_at: Column | None = None,
    hot_orders: DataFrame | None = None,
) -> DataFrame:
    """Every day at once, each day by itself, in one pass over the data."""
    def by_day(df: DataFrame) -> DataFrame:
        return df.withColumn("batch_date", F.to_date(utc_datetime("event_timestamp")))

    day_orders = latest_by(
        by_day(orders), ["batch_date", "order_id"], "event_timestamp", _ties(orders, ORDER_TIES)
    )
    day_payments = latest_by(
        by_day(payments), ["batch_date", "payment_id"], "event_timestamp",
        _ties(payments, PAYMENT_TIES),
    ).select("batch_date", "order_id", "processed_at", F.col("status").alias("payment_status"))
    joined = left_join(
        day_orders.select("batch_date", "order_id", "city", "payment_method", "platform",
                          "status", "total_vnd", "placed_at"),
        day_payments, ["batch_date", "order_id"], hot_orders,
    )
    return _summarise(joined, processed_at)


def _summarise(joined: DataFrame, processed_at: Column | None) -> DataFrame:
    delay = positive_delay_seconds(F.col("placed_at"), F.col("processed_at"))
    summary = joined.groupBy(*SUMMARY_KEYS).agg(
        F.count("order_id").alias("total_orders"),
        F.count_if(F.col("status") == "delivered").alias("delivered_orders"),
        F.count_if(F.col("status") == "cancelled").alias("cancelled_orders"),
        F.sum("total_vnd").alias("gross_revenue_vnd"),
        F.avg("total_vnd").alias("avg_order_vnd"),
        F.count_if(F.col("payment_status") == "success").alias("paid_orders"),
        F.avg(F.coalesce(delay, F.lit(0))).alias("avg_payment_delay_seconds"),
    )
    stamp = F.current_timestamp() if processed_at is None else processed_at
    return summary.withColumn("processed_at", stamp)


def latest_daily_summary(results: DataFrame) -> DataFrame:
    """Newest result per day and group, when several runs are stored."""
    return latest_by(results, SUMMARY_KEYS, "processed_at")
