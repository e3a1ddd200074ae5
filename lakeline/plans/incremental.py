"""Incremental run of the order fact.

The result equals filtering the full model by the lookback bound, but only the
orders that can pass the bound, and their payments, go through deduplication
and join. History is scanned, not shuffled.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import local_datetime
from ..operators import merge
from ..operators.joins import hot_keys
from ..session import scratch_dir
from ..sources.fs import Folder
from . import intermediate, marts, staging

#: No zone is further ahead of UTC, so a local bound minus this is a UTC bound.
MAX_ZONE_AHEAD = dt.timedelta(hours=14)


def _stored(spark: SparkSession, df: DataFrame, scratch: str) -> DataFrame:
    """Keys as a stored table.

    Its size is then a fact the planner knows: a small one is broadcast, a
    large one is shuffled.
    """
    df.write.parquet(scratch)
    return spark.read.schema(df.schema).parquet(scratch)


def incremental_fct_orders(
    spark: SparkSession,
    orders: DataFrame,
    payments: DataFrame,
    since_local: dt.datetime,
    scratch: str,
) -> DataFrame:
    """Fact rows placed at or after ``since_local``, from raw orders and payments.

    An order passes only if one of its versions was placed late enough; all
    versions of such orders take part, because the newest decides. Likewise all
    versions of every payment that ever pointed at one of them.
    """
    bound = F.lit(since_local.isoformat(sep=" ")).cast("timestamp_ntz")
    coarse = F.lit((since_local - MAX_ZONE_AHEAD).isoformat(sep=" ")).cast("timestamp")
    late = orders.where(
        (F.col("placed_at") >= coarse) & (local_datetime("placed_at") >= bound)
    )
    order_ids = _stored(spark, late.select("order_id").distinct(), f"{scratch}/orders")
    touching = _stored(spark, payments.join(order_ids, "order_id", "left_semi").select(
        "order_id", "payment_id"), f"{scratch}/touching")
    payment_ids = _stored(spark, touching.select("payment_id").distinct(), f"{scratch}/payments")
    candidates = intermediate.int_order_payments(
        staging.stg_orders(orders.join(order_ids, "order_id", "left_semi")),
        staging.stg_payments(payments.join(payment_ids, "payment_id", "left_semi")),
        hot_keys(touching, "order_id"),
    )
    return marts.fct_orders(candidates).where(F.col("placed_at_local") >= bound)


def run_incremental(
    spark: SparkSession,
    orders: DataFrame,
    payments: DataFrame,
    path: str,
    lookback: dt.timedelta = dt.timedelta(minutes=10),
    max_move_days: int | None = None,
    reach_days: int | None = None,
) -> list[str]:
    """Bring the stored fact up to date; a missing or empty table is built in full.

    Stored rows of the incoming orders are searched in the key column of the
    whole table. Where an order's date is known never to move by more than
    ``max_move_days``, only the partitions within that reach are searched.

    Raw tables with their ``load_date`` need not be read in full where no version of an order
    or payment that the lookback reaches was loaded more than ``reach_days`` before its bound:
    older loads are then not listed for the keys. Unset, all loads are read.
    """
    newest = merge.newest_instant(spark, path, "placed_date", "placed_at_local")
    if newest is None:
        full = marts.fct_orders(intermediate.int_order_payments(
            staging.stg_orders(orders), staging.stg_payments(payments),
            hot_keys(payments, "order_id"),
        ))
        return merge.upsert(spark, path, full, "order_id", "placed_date", ["city"])
    if reach_days is not None:
        oldest = F.lit((newest - lookback).date() - dt.timedelta(days=reach_days))
        orders, payments = (df.where(F.col("load_date") >= oldest) for df in (orders, payments))
    scratch = scratch_dir(spark, "increment")
    source = incremental_fct_orders(spark, orders, payments, newest - lookback, scratch)
    within = None
    if max_move_days is not None:
        reach = (newest - lookback).date() - dt.timedelta(days=max_move_days)
        within = F.col("placed_date") >= F.lit(reach)
    rewritten = merge.upsert(
        spark, path, source, "order_id", "placed_date", ["city"], within=within
    )
    Folder(spark, scratch).delete()
    return rewritten
