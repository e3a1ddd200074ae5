"""The 55 checks carried by the models."""

from __future__ import annotations

from functools import partial

from ..operators.quality import (
    ModelChecks, payment_cap_check, positive_revenue_check, valid_status_check,
)
from ..schemas import (
    CITIES, ORDER_STATUSES, PAYMENT_METHODS, PAYMENT_STATUSES, PLATFORMS, RIDER_STATUSES,
)


def model_checks() -> dict[str, ModelChecks]:
    return {
        "stg_orders": ModelChecks(
            lazy=True, unique=("order_id",),
            not_null=("order_id", "customer_id", "restaurant_id", "rider_id", "city", "status",
                      "payment_method", "platform", "total_vnd", "placed_date"),
            accepted=(("city", CITIES), ("status", ORDER_STATUSES),
                      ("payment_method", PAYMENT_METHODS), ("platform", PLATFORMS)),
        ),
        "stg_payments": ModelChecks(
            lazy=True, unique=("payment_id",),
            not_null=("payment_id", "order_id", "amount_vnd", "payment_method",
                      "payment_status", "processed_at_local"),
            accepted=(("payment_method", PAYMENT_METHODS),
                      ("payment_status", PAYMENT_STATUSES)),
        ),
        "stg_riders": ModelChecks(
            lazy=True, unique=("event_id",),
            not_null=("event_id", "rider_id", "city", "latitude", "longitude", "rider_status"),
            accepted=(("city", CITIES), ("rider_status", RIDER_STATUSES)),
        ),
        "stg_order_items": ModelChecks(
            not_null=("order_id", "item_id", "item_name", "quantity", "line_total_vnd"),
        ),
        "int_order_payments": ModelChecks(
            lazy=True, unique=("order_id",), not_null=("order_id",)
        ),
        "int_delivery_metrics": ModelChecks(not_null=("rider_id", "event_date")),
        "fct_orders": ModelChecks(
            unique=("order_id",),
            not_null=("order_id", "city", "placed_date", "total_vnd"),
            extra=(payment_cap_check, positive_revenue_check,
                   partial(valid_status_check, ORDER_STATUSES)),
        ),
        "dim_restaurant": ModelChecks(not_null=("restaurant_id", "total_orders")),
        "dim_rider": ModelChecks(not_null=("rider_id",)),
        "rpt_hourly_revenue": ModelChecks(not_null=("city", "hour_bucket")),
    }
