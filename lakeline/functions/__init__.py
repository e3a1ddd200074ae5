"""Column helpers: built-in expressions only, no UDF."""

from .business import flag, meal_period, positive_delay_seconds
from .ids import uuid_or_null, uuid_strict
from .text import readable_quantity, readable_size
from .timestamps import (
    best_effort_timestamp,
    hour_bucket,
    local_date,
    local_datetime,
    strict_timestamp,
    utc_datetime,
    utc_hour,
    wall_seconds,
    with_event_date_parts,
)

__all__ = [
    "best_effort_timestamp", "flag", "hour_bucket", "local_date", "local_datetime",
    "meal_period", "positive_delay_seconds", "readable_quantity", "readable_size",
    "strict_timestamp", "utc_datetime", "utc_hour", "uuid_or_null", "uuid_strict",
    "wall_seconds", "with_event_date_parts",
]
