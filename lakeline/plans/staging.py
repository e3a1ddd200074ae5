"""Staging models: clean, rename, derive local clocks, keep the newest version."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import local_date, local_datetime
from ..operators.dedup import latest_by
from ..schemas import ITEM_ARRAY

# Versions of one key with the same event time are ordered by these columns, so
# that reruns pick the same survivor.
ORDER_TIES = ("producer_ts", "placed_at", "total_vnd", "status")
PAYMENT_TIES = (
    "producer_ts", "processed_at", "amount_vnd", "status", "method", "gateway_transaction_id",
)
RIDER_TIES = ("producer_ts", "battery_pct", "status")


def _ties(df: DataFrame, ties: tuple[str, ...]) -> list[str]:
    return [c for c in ties if c in df.columns]


def _thousands(c: str) -> Column:
    return F.col(c) / F.lit(1000.0)


def stg_orders(raw: DataFrame) -> DataFrame:
    # The amount filter runs first: a newer version without an amount must not
    # hide an older one that has it.
    priced = raw.where(F.col("total_vnd") > 0)
    newest = latest_by(priced, ["order_id"], "event_timestamp", _ties(raw, ORDER_TIES))
    local = local_datetime("placed_at")
    return newest.select(
        "order_id", "customer_id", "restaurant_id", "rider_id", "city", "district",
        F.lower("status").alias("status"),
        "items", "subtotal_vnd", "delivery_fee_vnd", "discount_vnd", "total_vnd",
        _thousands("total_vnd").alias("total_k_vnd"),
        "payment_method", "platform",
        local.alias("placed_at_local"),
        F.to_date(local).alias("placed_date"),
        F.hour(local).alias("placed_hour"),
        "event_timestamp",
    )


def stg_payments(raw: DataFrame) -> DataFrame:
    newest = latest_by(raw, ["payment_id"], "event_timestamp", _ties(raw, PAYMENT_TIES))
    return newest.select(
        "payment_id", "order_id", "amount_vnd",
        _thousands("amount_vnd").alias("amount_k_vnd"),
        F.col("method").alias("payment_method"),
        F.lower("status").alias("payment_status"),
        "gateway_transaction_id",
        local_datetime("processed_at").alias("processed_at_local"),
        "event_timestamp",
    )


def stg_riders(raw: DataFrame) -> DataFrame:
    newest = latest_by(raw, ["event_id"], "event_timestamp", _ties(raw, RIDER_TIES))
    local = local_datetime("event_timestamp")
    return newest.select(
        "event_id", "rider_id", "order_id", "city", "latitude", "longitude", "speed_kmh",
        F.lower("status").alias("rider_status"),
        "battery_pct", "event_timestamp",
        F.to_date(local).alias("event_date"),
        F.hour(local).alias("event_hour"),
    )


def stg_order_items(raw: DataFrame, dedup: bool = False, lenient: bool = False) -> DataFrame:
    """One row per element of the JSON array in ``items``.

    Raw orders are read as they are, so a replayed order repeats its items
    unless ``dedup``. Numbers may be quoted in the JSON, hence text fields and
    a cast; ``lenient`` turns unreadable numbers into NULL instead of failing.
    """
    if dedup:
        raw = latest_by(raw, ["order_id"], "event_timestamp", _ties(raw, ORDER_TIES))
    # from_json would accept a bare object as a one-element array.
    is_array = F.ltrim("items", F.lit(" \t\r\n")).startswith("[")
    filled = raw.where(F.col("items").isNotNull() & ~F.col("items").isin("[]", "") & is_array)
    exploded = filled.select(
        "order_id", "city", local_date("placed_at").alias("placed_date"),
        F.explode(F.from_json("items", ITEM_ARRAY)).alias("item"),
    )

    def number(name: str) -> Column:
        field = F.col("item").getField(name)
        return field.try_cast("bigint") if lenient else field.cast("bigint")

    return exploded.where(F.col("item.item_id") != "").select(
        "order_id", "city", "placed_date",
        F.col("item.item_id").alias("item_id"),
        F.col("item.name").alias("item_name"),
        number("price_vnd").alias("price_vnd"),
        number("quantity").alias("quantity"),
        (number("price_vnd") * number("quantity")).alias("line_total_vnd"),
    )
