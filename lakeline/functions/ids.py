"""Identifier validation."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

UUID_PATTERN = "^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$"


def uuid_or_null(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.when(c.rlike(UUID_PATTERN), F.lower(c))


def uuid_strict(c: Column | str) -> Column:
    """Fail the query on text that is not a UUID; NULL stays NULL."""
    c = F.col(c) if isinstance(c, str) else c
    message = F.concat(F.lit("not a UUID: "), c)
    return (
        F.when(c.isNull(), F.lit(None).cast("string"))
        .when(c.rlike(UUID_PATTERN), F.lower(c))
        .otherwise(F.raise_error(message).cast("string"))
    )
