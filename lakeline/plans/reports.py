"""Analytical queries over raw tables and marts."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import local_datetime, utc_datetime, utc_hour


def since(ts: str, as_of: dt.datetime | Column, days: int) -> Column:
    """``ts >= as_of - days``; a literal bound reaches the Parquet scan."""
    if isinstance(as_of, Column):
        return F.col(ts) >= as_of - F.expr(f"INTERVAL {days} DAYS")
    return F.col(ts) >= F.lit(as_of - dt.timedelta(days=days))


def hourly_revenue(orders: DataFrame, as_of, days: int = 7) -> DataFrame:
    cancelled = F.count_if(F.col("status") == "cancelled")
    return (
        orders.where(since("placed_at", as_of, days))
        .groupBy("city", utc_hour("placed_at").alias("hour"))
        .agg(
            F.count("*").alias("total_orders"),
            F.sum("total_vnd").alias("revenue_vnd"),
            F.avg("delivery_fee_vnd").alias("avg_delivery_fee"),
            (cancelled / F.count("*")).alias("cancellation_rate"),
        )
        .orderBy(F.desc("hour"), "city")
    )


def hourly_volume(orders: DataFrame, as_of, days: int = 7) -> DataFrame:
    """The short form of the hourly query used as a concurrency probe."""
    return (
        orders.where(since("placed_at", as_of, days))
        .groupBy("city", utc_hour("placed_at").alias("hour"))
        .agg(F.count("*").alias("total_orders"), F.sum("total_vnd").alias("revenue_vnd"))
        .orderBy(F.desc("hour"), "city")
    )


def method_share(orders: DataFrame, as_of, days: int = 30) -> DataFrame:
    return (
        orders.where(since("placed_at", as_of, days)).groupBy("city", "payment_method")
        .agg(F.count("*").alias("orders"), F.sum("total_vnd").alias("revenue_vnd"))
        .orderBy("city", F.desc("revenue_vnd"), "payment_method")
    )


def district_volume(orders: DataFrame, as_of, days: int = 30) -> DataFrame:
    return (
        orders.where(since("placed_at", as_of, days)).groupBy("city", "district")
        .agg(F.count("*").alias("orders"), F.avg("total_vnd").alias("avg_order_value_vnd"))
        .orderBy("city", F.desc("orders"), "district")
    )


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("total"))


def by_city(orders: DataFrame) -> DataFrame:
    return orders.groupBy("city").agg(F.count("*").alias("orders"))


def paid_by_city(orders: DataFrame, payments: DataFrame) -> DataFrame:
    """Raw orders joined to raw payments, summed by city.

    Copies multiply: an order stored m times with n payment rows counts m * n.
    Both sides are grouped by order before the join, so the product is
    multiplied out as numbers and never as rows, even for one huge order.
    """
    order_rows = orders.groupBy("order_id", "city").agg(F.count("*").alias("o_rows"))
    payment_rows = payments.groupBy("order_id").agg(
        F.count("*").alias("p_rows"), F.sum("amount_vnd").alias("p_amount")
    )
    return order_rows.join(payment_rows, "order_id").groupBy("city").agg(
        F.sum(F.col("o_rows") * F.col("p_rows")).alias("orders"),
        F.sum(F.col("o_rows") * F.col("p_amount")).alias("paid"),
    )


def by_local_hour(orders: DataFrame) -> DataFrame:
    return (
        orders.groupBy(F.hour(local_datetime("placed_at")).alias("hr"))
        .agg(F.count("*").alias("orders")).orderBy("hr")
    )


def daily_revenue_utc(orders: DataFrame) -> DataFrame:
    return (
        orders.groupBy(F.to_date(utc_datetime("placed_at")).alias("d"))
        .agg(F.sum("total_vnd").alias("rev"), F.count("*").alias("orders")).orderBy("d")
    )


def city_revenue_millions(fct: DataFrame) -> DataFrame:
    return (
        fct.groupBy("city")
        .agg(F.count("*").alias("orders"), (F.sum("total_vnd") / F.lit(1e6)).alias("rev_m"))
        .orderBy(F.desc("rev_m"), "city")
    )


def fact_join_report(fct: DataFrame, rpt: DataFrame, n: int | None = 10) -> DataFrame:
    """Fact rows joined to the hourly report rows of their date, counted per revenue value.

    Many to many by date. Both sides are counted per join key first, so the
    join sees one row per date and value instead of every pair.
    """
    per_date = fct.groupBy("placed_date").agg(F.count("*").alias("f_rows"))
    per_value = rpt.groupBy(
        F.to_date("hour_bucket").alias("placed_date"), "total_revenue_vnd"
    ).agg(F.count("*").alias("r_rows"))
    joined = per_date.join(per_value, "placed_date").select(
        "placed_date", (F.col("f_rows") * F.col("r_rows")).alias("orders"), "total_revenue_vnd"
    )
    return joined.orderBy("placed_date", "total_revenue_vnd").limit(n) if n else joined


def city_hour_pattern(fct: DataFrame, city: str = "hcmc") -> DataFrame:
    return (
        fct.where(F.col("city") == city).groupBy("placed_hour")
        .agg(F.avg("total_vnd").alias("avg_order"), F.count("*").alias("orders"))
        .orderBy("placed_hour")
    )


def report_latest(rpt: DataFrame) -> DataFrame:
    return rpt.select("city", "hour_bucket", "total_revenue_vnd", "total_orders").orderBy(
        F.desc("hour_bucket"), "city"
    )


#: Values of a bucket of the exact percentiles; a task sees so many distinct ones at most.
BUCKET_VALUES = 1_000


def exact_percentiles(counts: DataFrame, by: Sequence[str], value: str, n: str,
                      probs: Sequence[float], width: int = BUCKET_VALUES) -> DataFrame:
    """``by``, ``samples`` and an array ``p`` of percentiles, interpolated, of whole numbers
    that occur ``n`` times each.

    Running counts go over buckets of ``width`` values; only the buckets that hold a wanted rank
    are then counted value by value. A group may have any number of distinct values.
    """
    group = F.struct(F.lit(0).alias("__all"), *by).alias("__by")
    rows = counts.select(group, F.col(value).alias("__v"), F.col(n).alias("__n"),
                         F.floor(F.col(value) / width).alias("__bucket"))
    buckets = rows.groupBy("__by", "__bucket").agg(F.sum("__n").alias("__m"))
    whole = Window.partitionBy("__by")
    earlier = whole.orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    placed = buckets.select(
        "__by", "__bucket", "__m", F.sum("__m").over(whole).alias("samples"),
        F.coalesce(F.sum("__m").over(earlier), F.lit(0)).alias("__before"))

    def ranks(prob: float) -> list[Column]:
        low = F.floor(F.lit(prob) * (F.col("samples") - 1))
        return [low, F.least(low + 1, F.col("samples") - 1)]

    def holds(rank: Column, before: Column, size: Column) -> Column:
        return (before <= rank) & (rank < before + size)

    wanted = [rank for prob in probs for rank in ranks(prob)]
    some = F.lit(False)
    for rank in wanted:
        some = some | holds(rank, F.col("__before"), F.col("__m"))
    inside = Window.partitionBy("__by", "__bucket").orderBy("__v").rowsBetween(
        Window.unboundedPreceding, -1)
    fine = rows.join(placed.where(some), ["__by", "__bucket"]).withColumn(
        "__at", F.col("__before") + F.coalesce(F.sum("__n").over(inside), F.lit(0)))
    found = fine.groupBy("__by").agg(
        F.first("samples").alias("samples"),
        *(F.max(F.when(holds(rank, F.col("__at"), F.col("__n")), F.col("__v"))).alias(f"__r{i}")
          for i, rank in enumerate(wanted)))

    def between(i: int, prob: float) -> Column:
        low, high = F.col(f"__r{2 * i}"), F.col(f"__r{2 * i + 1}")
        part = F.lit(prob) * (F.col("samples") - 1) - ranks(prob)[0]
        return low + part * (high - low)

    return found.select(
        *(F.col("__by")[c].alias(c) for c in by), "samples",
        F.array(*(between(i, prob) for i, prob in enumerate(probs))).alias("p"))


def ingest_millis() -> Column:
    """``_ingested_at - producer_ts`` in whole milliseconds."""
    micros = F.unix_micros("_ingested_at") - F.round(F.col("producer_ts") * 1e6).cast("bigint")
    return F.round(micros / F.lit(1000.0)).cast("bigint")


def ingest_latency(
    df: DataFrame,
    probs: Sequence[float] = (0.5, 0.95),
    by: Sequence[str] = (),
    exact: bool = False,
    accuracy: int = 10_000,
) -> DataFrame:
    """Percentiles of ``_ingested_at - producer_ts`` in seconds.

    The default is a sketch of bounded size. ``exact`` counts rows per
    millisecond first and then looks at the buckets that matter only.
    """
    ms = ingest_millis()
    if exact:
        counts = df.groupBy(*by, ms.alias("ms")).agg(F.count("*").alias("n"))
        grouped = exact_percentiles(counts.where(F.col("ms").isNotNull()), by, "ms", "n", probs)
    else:
        grouped = df.withColumn("ms", ms).groupBy(*by).agg(
            F.count("ms").alias("samples"),
            F.approx_percentile("ms", list(probs), accuracy).alias("p"),
        )
    names = [f"p{prob * 100:g}".replace(".", "_") + "_seconds" for prob in probs]
    return grouped.select(
        *by, "samples",
        *[(F.col("p")[i] / F.lit(1000.0)).alias(name) for i, name in enumerate(names)],
    )


def throughput_per_minute(df: DataFrame, ts: str, by: Sequence[str] = ()) -> DataFrame:
    """Rows per minute: the minutes that had rows with their mean and peak, and the mean over all
    minutes from the first to the last, in which a stalled feed shows."""
    minutes = df.groupBy(*by, F.date_trunc("minute", ts).alias("minute")).agg(
        F.count("*").alias("n")
    )
    span = F.unix_seconds(F.max("minute")) - F.unix_seconds(F.min("minute"))
    elapsed = F.floor(span / 60) + 1
    return minutes.groupBy(*by).agg(
        F.count("*").alias("minutes"),
        F.sum("n").alias("total_rows"),
        F.avg("n").alias("rows_per_minute"),
        F.max("n").alias("peak_rows"),
        elapsed.alias("elapsed_minutes"),
        (F.sum("n") / elapsed).alias("rows_per_elapsed_minute"),
    )
