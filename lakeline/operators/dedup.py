"""Batch deduplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

_RANK = "__rank"


def latest_by(
    df: DataFrame, keys: Sequence[str], version: str, tie: Sequence[str] = ()
) -> DataFrame:
    """One row per key: the highest ``version``, ties decided by ``tie`` descending and then by a
    hash of the whole row, so that the order is total and every run keeps the same row.

    Filtering ``row_number`` to 1 lets Spark keep one row per key in every map
    task before the shuffle (a partial window group limit), so a key with very
    many copies reaches its reduce task as one row per map task.
    """
    order = [F.col(c).desc_nulls_last() for c in (version, *tie)]
    order.append(F.xxhash64(*(F.col(f"`{c}`") for c in df.columns)).desc())
    window = Window.partitionBy(*keys).orderBy(*order)
    return (
        df.withColumn(_RANK, F.row_number().over(window)).where(F.col(_RANK) == 1).drop(_RANK)
    )


def replacing_read(
    df: DataFrame,
    keys: Sequence[str],
    version: str,
    final: bool = True,
    tie: Sequence[str] = (),
) -> DataFrame:
    """Read a versioned table deduplicated (``final``) or as stored."""
    return latest_by(df, keys, version, tie) if final else df


def duplicate_report(df: DataFrame, keys: Sequence[str], by: Sequence[str]) -> DataFrame:
    """Rows, distinct keys and surplus copies per group.

    Counting copies per key first and then summing needs no distinct
    aggregate, and both steps combine on the map side.
    """
    grain = list(dict.fromkeys([*by, *keys]))
    copies = df.groupBy(*grain).agg(F.count("*").alias("copies"))
    return copies.groupBy(*by).agg(
        F.sum("copies").alias("raw_rows"),
        F.count("*").alias("final_rows"),
        F.sum(F.col("copies") - 1).alias("duplicate_rows"),
    )
