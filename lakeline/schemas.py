"""Declared schemas and value domains (S02). Nothing is ever inferred."""

from __future__ import annotations

from pyspark.sql import types as T

# Fixed values of the business domain.
CITIES = ("hanoi", "hcmc", "danang")
ORDER_STATUSES = ("placed", "confirmed", "preparing", "picked_up", "delivered", "cancelled")
PAYMENT_METHODS = ("cash", "momo", "vnpay", "zalopay", "bank_transfer")
PLATFORMS = ("android", "ios", "web")
PAYMENT_STATUSES = ("success", "failed", "refunded")
RIDER_STATUSES = ("available", "on_delivery", "returning")
LOCAL_ZONE = "Asia/Ho_Chi_Minh"

# Names, types and optional fields of the wire contract.
ORDERS = T.StructType([
    T.StructField("order_id", T.StringType(), False),
    T.StructField("customer_id", T.StringType(), False),
    T.StructField("restaurant_id", T.StringType(), False),
    T.StructField("rider_id", T.StringType(), False),
    T.StructField("city", T.StringType(), False),
    T.StructField("district", T.StringType(), False),
    T.StructField("status", T.StringType(), False),
    T.StructField("items", T.StringType(), False),
    T.StructField("subtotal_vnd", T.LongType(), False),
    T.StructField("delivery_fee_vnd", T.LongType(), False),
    T.StructField("discount_vnd", T.LongType(), False),
    T.StructField("total_vnd", T.LongType(), False),
    T.StructField("payment_method", T.StringType(), False),
    T.StructField("platform", T.StringType(), False),
    T.StructField("placed_at", T.TimestampType(), False),
    T.StructField("event_timestamp", T.TimestampType(), False),
    T.StructField("producer_ts", T.DoubleType(), True),
])

PAYMENTS = T.StructType([
    T.StructField("payment_id", T.StringType(), False),
    T.StructField("order_id", T.StringType(), False),
    T.StructField("amount_vnd", T.LongType(), False),
    T.StructField("method", T.StringType(), False),
    T.StructField("status", T.StringType(), False),
    T.StructField("gateway_transaction_id", T.StringType(), True),
    T.StructField("processed_at", T.TimestampType(), False),
    T.StructField("event_timestamp", T.TimestampType(), False),
    T.StructField("producer_ts", T.DoubleType(), True),
])

RIDER_EVENTS = T.StructType([
    T.StructField("event_id", T.StringType(), False),
    T.StructField("rider_id", T.StringType(), False),
    T.StructField("order_id", T.StringType(), True),
    T.StructField("city", T.StringType(), False),
    T.StructField("latitude", T.DoubleType(), False),
    T.StructField("longitude", T.DoubleType(), False),
    T.StructField("speed_kmh", T.DoubleType(), False),
    T.StructField("status", T.StringType(), False),
    T.StructField("battery_pct", T.IntegerType(), False),
    T.StructField("event_timestamp", T.TimestampType(), False),
    T.StructField("producer_ts", T.DoubleType(), True),
])

ITEM_ARRAY = "array<struct<item_id:string,name:string,price_vnd:string,quantity:string>>"

#: topic -> (schema, key column)
TOPICS = {
    "orders": (ORDERS, "order_id"),
    "payments": (PAYMENTS, "payment_id"),
    "rider_events": (RIDER_EVENTS, "event_id"),
}


def required(schema: T.StructType) -> list[str]:
    return [f.name for f in schema if not f.nullable]
