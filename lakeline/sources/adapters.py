"""The given star-schema tables seen as raw order, payment and courier events.

Every row of the source tables takes part. ``orders`` yields two versions per
order (placed, then its last status), each ``lineitem`` row is a version of the
payment of its order, and each ``events`` row is delivered twice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

EPOCH_MS = 1_704_067_200_000  # 2024-01-01 UTC
SPAN_SECONDS = 1_209_600      # 14 days


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def uuid_of(kind: int, key: Column) -> Column:
    """Key as UUID text, low digits first; ``kind`` keeps the entities apart."""
    digits = F.reverse(F.lpad(key.cast("string"), 12, "0"))
    return F.concat(
        F.substring(digits, 1, 8), F.lit("-"), F.substring(digits, 9, 4),
        F.lit(f"-4000-8000-00000000000{kind}"),
    )


def placed_ms(key: Column) -> Column:
    seconds = (key * 7919) % SPAN_SECONDS
    return F.lit(EPOCH_MS) + seconds * 1000 + (key % 10) * 100


def _city(key: Column) -> Column:
    return F.when(key % 3 == 0, "hanoi").when(key % 3 == 1, "hcmc").otherwise("danang")


def _instant(ms: Column) -> Column:
    return F.timestamp_millis(ms)


def raw_orders(spark: SparkSession, sf_dir: str, ingested: bool = False) -> DataFrame:
    k = F.col("o_orderkey")
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nations = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    base = (
        table(spark, sf_dir, "orders")
        .join(customers, F.col("o_custkey") == F.col("c_custkey"), "left")
        .join(nations, F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .withColumns({
            "ver": F.explode(F.array(F.lit(0), F.lit(1))),
            "subtotal_vnd": F.round(F.col("o_totalprice") * 100).cast("bigint"),
            "delivery_fee_vnd": F.lit(15000) + (k % 5) * 1000,
            "placed_ms": placed_ms(k),
        })
        .withColumn("discount_vnd", F.when(
            (k % 97 == 0) & (F.col("ver") == 1), F.col("subtotal_vnd") + F.col("delivery_fee_vnd")
        ).otherwise((k % 7) * 500))
        .withColumn("event_ms", F.col("placed_ms") + F.col("ver") * 1_200_000)
    )
    status = (
        F.when(F.col("ver") == 0, "PLACED")
        .when(F.col("o_orderstatus") == "F", "delivered")
        .when(F.col("o_orderstatus") == "P", "cancelled")
        .otherwise("CONFIRMED")
    )
    methods = ("1-URGENT", "cash"), ("2-HIGH", "momo"), ("3-MEDIUM", "vnpay"), ("5-LOW", "zalopay")
    method = F.lit("bank_transfer")
    for priority, name in methods:
        method = F.when(F.col("o_orderpriority") == priority, name).otherwise(method)
    items = F.concat(
        F.lit('[{"item_id":"I'), k.cast("string"), F.lit('","name":"'), F.col("n_name"),
        F.lit('","price_vnd":'), F.col("subtotal_vnd").cast("string"), F.lit(',"quantity":1}]'),
    )
    out = base.select(
        uuid_of(1, k).alias("order_id"),
        uuid_of(2, F.col("o_custkey")).alias("customer_id"),
        uuid_of(3, F.col("o_custkey") % 500).alias("restaurant_id"),
        uuid_of(4, k % 200).alias("rider_id"),
        _city(F.col("c_nationkey")).alias("city"),
        F.col("n_name").alias("district"),
        status.alias("status"),
        items.alias("items"),
        "subtotal_vnd", "delivery_fee_vnd", "discount_vnd",
        F.greatest(
            F.lit(0).cast("bigint"),
            F.col("subtotal_vnd") + F.col("delivery_fee_vnd") - F.col("discount_vnd"),
        ).alias("total_vnd"),
        method.alias("payment_method"),
        F.when(k % 3 == 0, "android").when(k % 3 == 1, "ios").otherwise("web").alias("platform"),
        _instant(F.col("placed_ms")).alias("placed_at"),
        _instant(F.col("event_ms")).alias("event_timestamp"),
        (F.col("event_ms") / F.lit(1000.0)).alias("producer_ts"),
        _instant(F.col("event_ms") + (k * 31) % 9000).alias("_ingested_at"),
    )
    return out if ingested else out.drop("_ingested_at")


def raw_item_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order events whose item text covers the shapes the item model has to handle."""
    price = F.round(F.col("p_retailprice") * 100).cast("bigint").cast("string")
    quantity = F.col("l_quantity").cast("bigint").cast("string")
    item = F.concat(
        F.lit('[{"item_id":"'), F.col("l_partkey").cast("string"), F.lit('","name":"'),
        F.col("p_name"), F.lit('","price_vnd":"'), price, F.lit('","quantity":'), quantity,
        F.lit('},{"item_id":"","name":"void","price_vnd":1,"quantity":1},'
              '{"name":"no id","price_vnd":1,"quantity":1},'
              '{"item_id":"fee","name":"packing","price_vnd":2000,"quantity":2}]'),
    )
    line = F.col("l_linenumber")
    items = (
        F.when(line == 6, F.lit("[]")).when(line == 7, F.lit(""))
        .when((line == 5) & (F.col("l_returnflag") == "R"), F.lit(None).cast("string"))
        .when((line == 5) & (F.col("l_returnflag") == "N"), F.lit('{"item_id":"bare"}'))
        .when((line == 5) & (F.col("l_returnflag") == "A"), F.lit("[{broken"))
        .otherwise(item)
    )
    k = F.col("l_orderkey")
    return (
        table(spark, sf_dir, "lineitem")
        .join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
        .select(
            uuid_of(1, k).alias("order_id"), _city(k).alias("city"),
            _instant(placed_ms(k)).alias("placed_at"), items.alias("items"),
        )
    )


def raw_payments(spark: SparkSession, sf_dir: str, ingested: bool = False) -> DataFrame:
    k = F.col("l_orderkey")
    event_ms = (
        F.lit(EPOCH_MS) + ((k * 7919) % SPAN_SECONDS) * 1000
        + F.col("l_linenumber").cast("bigint") * 60_000
    )
    processed_ms = (
        placed_ms(k) + F.col("l_quantity").cast("bigint") * 10_000 - 200_000
        + (F.col("l_partkey") % 10) * 100
    )
    cash = F.col("l_returnflag") == "N"
    out = table(spark, sf_dir, "lineitem").select(
        uuid_of(5, k).alias("payment_id"),
        uuid_of(1, k).alias("order_id"),
        F.round(F.col("l_extendedprice") * 100).cast("bigint").alias("amount_vnd"),
        F.when(F.col("l_returnflag") == "A", "momo").when(cash, "cash").otherwise("vnpay")
        .alias("method"),
        F.when(F.col("l_linestatus") == "F", "SUCCESS")
        .when(F.col("l_returnflag") == "R", "refunded").otherwise("failed").alias("status"),
        F.when(~cash, F.concat(F.lit("GW-"), F.col("l_suppkey").cast("string")))
        .alias("gateway_transaction_id"),
        _instant(processed_ms).alias("processed_at"),
        _instant(event_ms).alias("event_timestamp"),
        (event_ms / F.lit(1000.0)).alias("producer_ts"),
        _instant(event_ms + (F.col("l_partkey") * 17) % 7000).alias("_ingested_at"),
    )
    return out if ingested else out.drop("_ingested_at")


def raw_rider_events(spark: SparkSession, sf_dir: str, ingested: bool = False) -> DataFrame:
    user, kind = F.col("user_id"), F.col("event_type")
    base = table(spark, sf_dir, "events").withColumns({
        "ver": F.explode(F.array(F.lit(0), F.lit(1))),
        "micros": F.unix_micros(F.col("ts").cast("timestamp")),
    }).withColumn("event_micros", F.col("micros") + F.col("ver") * 500_000)
    out = base.select(
        uuid_of(6, F.col("event_id")).alias("event_id"),
        uuid_of(4, user).alias("rider_id"),
        F.when(kind == "purchase", uuid_of(1, F.col("event_id"))).alias("order_id"),
        _city(user).alias("city"),
        (F.lit(10.0) + user / F.lit(128.0)).alias("latitude"),
        (F.lit(106.0) + user / F.lit(256.0)).alias("longitude"),
        F.when(kind == "view", F.lit(0.0)).otherwise(F.floor(F.col("value") * 4) / F.lit(4.0))
        .alias("speed_kmh"),
        F.when(kind == "purchase", "ON_DELIVERY").when(kind == "view", "available")
        .when(kind == "click", "returning").otherwise(kind).alias("status"),
        (F.get_json_object("props", "$.k").cast("int") - F.col("ver")).alias("battery_pct"),
        F.timestamp_micros("event_micros").alias("event_timestamp"),
        (F.col("event_micros") / F.lit(1e6)).alias("producer_ts"),
        F.timestamp_micros(F.col("event_micros") + 2_500_000).alias("_ingested_at"),
    )
    return out if ingested else out.drop("_ingested_at")


def raw_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {
        "orders": raw_orders(spark, sf_dir),
        "payments": raw_payments(spark, sf_dir),
        "rider_events": raw_rider_events(spark, sf_dir),
    }


def backlog_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as backlog readings: one subscription per event type."""
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("subscription"), F.col("ts").cast("timestamp").alias("ts"),
        F.floor(F.col("value") * 200).cast("bigint").alias("backlog"), "event_id",
    )


def metric_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as counter samples: one series per user, restarting from time to time."""
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("metric"), F.col("user_id").alias("instance"),
        F.col("ts").cast("timestamp").alias("ts"),
        (F.col("event_id") % 1000).cast("double").alias("value"), "event_id",
    )
