"""The model graph as function composition."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.joins import hot_keys
from ..session import scratch_dir
from ..sources.buckets import write_bucketed
from ..sources.ledger import read_table
from ..sources.tables import materialize
from . import intermediate, marts, staging
from .incremental import run_incremental

MART_LAYOUT = {
    "fct_orders": (("placed_date",), ("city",)),
    "rpt_hourly_revenue": (("hour_date",), ("city",)),
    "dim_restaurant": ((), ("city",)),
    "dim_rider": ((), ("city",)),
}


def _views(raw: dict[str, DataFrame], hot: DataFrame | None,
           buckets: int | None = None) -> dict[str, DataFrame]:
    out = {
        "stg_orders": staging.stg_orders(raw["orders"]),
        "stg_payments": staging.stg_payments(raw["payments"]),
        "stg_riders": staging.stg_riders(raw["rider_events"]),
        "stg_order_items": staging.stg_order_items(raw["orders"]),
    }
    if buckets:
        for name in ("stg_orders", "stg_payments"):
            path = scratch_dir(out[name].sparkSession, name)
            out[name] = write_bucketed(out[name], path, "order_id", buckets)
    out["int_order_payments"] = intermediate.int_order_payments(
        out["stg_orders"], out["stg_payments"], hot
    )
    out["int_delivery_metrics"] = intermediate.int_delivery_metrics(out["stg_riders"])
    return out


def _stored(name: str, df: DataFrame, warehouse: str) -> DataFrame:
    partition_by, cluster_by = MART_LAYOUT[name]
    if name == "rpt_hourly_revenue":
        df = df.selectExpr("*", "to_date(hour_bucket) AS hour_date")
    path = f"{warehouse.rstrip('/')}/{name}"
    return materialize(
        df, "table", path, partition_by=partition_by, cluster_by=cluster_by
    ).drop("hour_date")


def _marts_after_fact(out: dict[str, DataFrame], keep) -> None:
    out["dim_restaurant"] = keep("dim_restaurant", marts.dim_restaurant(out["fct_orders"]))
    out["rpt_hourly_revenue"] = keep(
        "rpt_hourly_revenue", marts.rpt_hourly_revenue(out["fct_orders"])
    )
    out["dim_rider"] = keep("dim_rider", marts.dim_rider(out["int_delivery_metrics"]))


def run_models(
    spark: SparkSession,
    raw: dict[str, DataFrame],
    warehouse: str | None = None,
    split_hot_orders: bool = True,
    buckets: int | None = None,
) -> dict[str, DataFrame]:
    """All ten models in full from ``raw`` = {orders, payments, rider_events}.

    Staging and intermediate models stay lazy. With ``warehouse`` the marts are
    written there and later models read the written fact, so the fact is
    computed once; without it everything stays lazy. With ``buckets`` staged
    orders and payments are written once, in so many buckets of ``order_id``,
    and all that joins or groups them by order reads those without a shuffle.
    """
    hot = hot_keys(raw["payments"], "order_id") if split_hot_orders else None
    out = _views(raw, hot, buckets)

    def keep(name: str, df: DataFrame) -> DataFrame:
        return _stored(name, df, warehouse) if warehouse else df

    out["fct_orders"] = keep("fct_orders", marts.fct_orders(out["int_order_payments"]))
    _marts_after_fact(out, keep)
    return out


def run_transform(
    spark: SparkSession, raw: dict[str, DataFrame], warehouse: str, full_refresh: bool = False,
    reach_days: int | None = None,
) -> dict[str, DataFrame]:
    """The scheduled run: incremental fact, then the other marts from the stored fact."""
    if full_refresh:
        return run_models(spark, raw, warehouse)
    out = _views(raw, hot_keys(raw["payments"], "order_id"))
    path = f"{warehouse.rstrip('/')}/fct_orders"
    run_incremental(spark, raw["orders"], raw["payments"], path, reach_days=reach_days)
    schema = marts.fct_orders(out["int_order_payments"]).schema
    out["fct_orders"] = read_table(spark, path, schema)
    _marts_after_fact(out, lambda name, df: _stored(name, df, warehouse))
    return out
