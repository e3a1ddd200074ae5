"""Intermediate models: orders with payments, courier days."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import meal_period, positive_delay_seconds
from ..operators.joins import left_join


def int_order_payments(
    orders: DataFrame, payments: DataFrame, hot_orders: DataFrame | None = None
) -> DataFrame:
    """Staged orders with their payments; unpaid orders keep NULL payment columns.

    ``hot_orders`` lists orders with very many payments (see
    ``operators.joins.hot_keys``); it changes the plan, never the rows.
    """
    left = orders.select(
        "order_id", "customer_id", "restaurant_id", "rider_id", "city", "district",
        F.col("status").alias("order_status"),
        "total_vnd", "total_k_vnd", "payment_method", "platform",
        meal_period("placed_hour").alias("meal_period"),
        "placed_at_local", "placed_date", "placed_hour",
    )
    right = payments.select(
        "order_id", "payment_id", "payment_status",
        F.col("amount_vnd").alias("payment_amount_vnd"),
        "processed_at_local",
    )
    return left_join(left, right, "order_id", hot_orders).withColumn(
        "payment_delay_seconds",
        positive_delay_seconds(F.col("placed_at_local"), F.col("processed_at_local"),
                               wall_clock=True),
    )


def int_delivery_metrics(riders: DataFrame) -> DataFrame:
    """GPS pings per courier, city and local day."""
    pings = F.count("*")
    delivering = F.count_if(F.col("rider_status") == "on_delivery")
    return riders.groupBy("rider_id", "city", "event_date").agg(
        pings.alias("total_pings"),
        delivering.alias("delivery_pings"),
        F.count_if(F.col("rider_status") == "available").alias("idle_pings"),
        F.avg("speed_kmh").alias("avg_speed_kmh"),
        F.max("speed_kmh").alias("max_speed_kmh"),
        F.avg("battery_pct").alias("avg_battery_pct"),
        F.min("battery_pct").alias("min_battery_pct"),
        F.round(delivering * F.lit(100.0) / pings, 1).alias("utilization_pct"),
    )
