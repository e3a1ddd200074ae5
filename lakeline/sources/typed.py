"""Typed ingest of all-text queue rows (S09, S10, ST14). Works on streams and batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import best_effort_timestamp, strict_timestamp, uuid_or_null, uuid_strict
from ..schemas import ORDERS, PAYMENTS, RIDER_EVENTS

_REQUIRED_UUIDS = {"order_id", "customer_id", "restaurant_id", "rider_id", "payment_id", "event_id"}


def _typed(df: DataFrame, schema, optional_uuids: set[str], strict: bool,
           ingested_at: Column | None) -> DataFrame:
    columns = []
    for field in schema:
        name, kind = field.name, field.dataType.typeName()
        if name in optional_uuids:
            c = uuid_or_null(name)
        elif name in _REQUIRED_UUIDS:
            c = uuid_strict(name) if strict else uuid_or_null(name)
        elif kind == "timestamp":
            c = strict_timestamp(name) if strict else best_effort_timestamp(name)
        elif strict:
            c = F.col(name).cast(field.dataType)
        else:
            c = F.col(name).try_cast(field.dataType)
        columns.append(c.alias(name))
    stamp = F.current_timestamp() if ingested_at is None else ingested_at
    return df.select(*columns, stamp.alias("_ingested_at"))


def typed_orders(df: DataFrame, strict: bool = True, ingested_at: Column | None = None):
    return _typed(df, ORDERS, set(), strict, ingested_at)


def typed_payments(df: DataFrame, strict: bool = True, ingested_at: Column | None = None):
    return _typed(df, PAYMENTS, set(), strict, ingested_at)


def typed_rider_events(df: DataFrame, strict: bool = True, ingested_at: Column | None = None):
    """The courier's order is optional: empty text becomes NULL."""
    return _typed(df, RIDER_EVENTS, {"order_id"}, strict, ingested_at)


def from_broker(spark, servers: str, topic: str, **options: str) -> DataFrame:
    """Message values of a broker topic; needs the public spark-sql-kafka package."""
    reader = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
    for key, value in options.items():
        reader = reader.option(key, value)
    return reader.option("subscribe", topic).load().select(F.col("value").cast("string"))
