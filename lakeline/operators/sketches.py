"""Stored sketches per hour or day that merge over any range (A04, A19, D05, ST09).

A sketch has a bounded size whatever it has seen, and sketches of parts add up to one of the
whole. So a range is answered from one small row per hour and group, and events are read once.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..sources.ledger import Ledger
from .dedup import duplicate_report

#: Size of a quantile sketch; a rank of one is off by more than ``RANK_ERROR`` in about one of a
#: hundred cases.
KLL_K, RANK_ERROR = 800, 0.0045
#: Size of a distinct sketch (log2 of its buckets), and its relative standard error.
HLL_K, COUNT_ERROR = 14, 1.04 / 2 ** 7
DAY, HOUR = "sketch_date", "hour"


def quantile_sketches(df: DataFrame, ts: str, value: Column, by: Sequence[str] = ()) -> DataFrame:
    """Per group and UTC hour of ``ts``: samples, smallest, largest and a sketch of the value,
    which is cut to a whole number; rows without it don't count. Rows without a time have none."""
    rows = df.select(*by, F.date_trunc("hour", ts).alias(HOUR), value.cast("bigint").alias("v"))
    return (
        rows.where(F.col("v").isNotNull() & F.col(HOUR).isNotNull()).groupBy(*by, HOUR)
        .agg(F.count("*").alias("samples"), F.min("v").alias("low"), F.max("v").alias("high"),
             F.kll_sketch_agg_bigint("v", KLL_K).alias("sketch"))
        .withColumn(DAY, F.to_date(HOUR))
    )


def distinct_sketches(df: DataFrame, ts: str, key: str, by: Sequence[str] = ()) -> DataFrame:
    """Per group and UTC hour of ``ts``: rows, and a sketch of their distinct keys."""
    rows = df.select(*by, F.date_trunc("hour", ts).alias(HOUR), F.col(key).alias("k"))
    return (
        rows.where(F.col(HOUR).isNotNull()).groupBy(*by, HOUR)
        .agg(F.count("*").alias("raw_rows"), F.hll_sketch_agg("k", HLL_K).alias("sketch"))
        .withColumn(DAY, F.to_date(HOUR))
    )


def store(sketches: DataFrame, path: str, load: tuple[str, int] | None = None) -> None:
    """Add sketches to the table at ``path``, by day. A repeated ``load`` (source, number)
    changes nothing. Several loads may have sketches of one hour: reading merges them."""
    Ledger(sketches.sparkSession, path).append(sketches, (DAY,), mark=load)


def stored_range(spark: SparkSession, path: str, since: dt.datetime,
                 until: dt.datetime) -> DataFrame:
    """Sketches of the hours from ``since`` to before ``until`` (UTC). Folders of other days are
    not listed."""
    table = Ledger(spark, path)
    now, day, parts = table.latest(), since.date(), set()
    while day <= until.date():
        parts.add(f"{DAY}={day.isoformat()}")
        day += dt.timedelta(days=1)
    instants = [F.lit(t.replace(tzinfo=t.tzinfo or dt.timezone.utc)) for t in (since, until)]
    return table.read(parts & {*now.parts()}, now).where(
        (F.col(HOUR) >= instants[0]) & (F.col(HOUR) < instants[1]))


def quantiles(sketches: DataFrame, probs: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """Per group: samples, low, high, and ``p``, an array of the quantiles, whose ranks are off
    by ``RANK_ERROR`` or a little more."""
    merged = sketches.groupBy(*by).agg(
        F.sum("samples").alias("samples"), F.min("low").alias("low"),
        F.max("high").alias("high"), F.kll_merge_agg_bigint("sketch", KLL_K).alias("sketch"))
    found = F.array(*(F.kll_sketch_get_quantile_bigint("sketch", F.lit(float(p))) for p in probs))
    return merged.where(F.col("samples") > 0).select(*by, "samples", "low", "high",
                                                     found.alias("p"))


def distinct_counts(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Per group: rows, and about how many distinct keys they have, whichever hours share them."""
    return sketches.groupBy(*by).agg(
        F.sum("raw_rows").alias("raw_rows"),
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("final_rows"))


def rank_errors(values: DataFrame, value: Column, found: DataFrame, probs: Sequence[float],
                by: Sequence[str]) -> DataFrame:
    """How far the rank of each quantile is from what it should be, by counting all values: per
    group ``samples`` and ``worst``, the largest distance as a share of the samples."""
    rows = values.select(*by, value.cast("bigint").alias("v")).where(F.col("v").isNotNull())
    joined = rows.join(found.select(*by, "p"), list(by))
    counted = joined.groupBy(*by).agg(
        F.count("*").alias("samples"),
        *(F.count_if(F.col("v") < F.col("p")[i]).alias(f"under{i}") for i in range(len(probs))),
        *(F.count_if(F.col("v") <= F.col("p")[i]).alias(f"upto{i}") for i in range(len(probs))))
    # A value that occurs often has a span of ranks; being inside it is no error.
    off = [F.greatest(F.lit(0.0), F.col(f"under{i}") / F.col("samples") - F.lit(p),
                      F.lit(p) - F.col(f"upto{i}") / F.col("samples"))
           for i, p in enumerate(probs)]
    return counted.select(*by, "samples", F.array_max(F.array(*off)).alias("worst"))


def distinct_errors(df: DataFrame, key: str, found: DataFrame, by: Sequence[str]) -> DataFrame:
    """Exact rows and distinct keys beside the estimate: ``off`` is its relative error."""
    exact = duplicate_report(df, [key], by)
    return exact.join(found.select(*by, F.col("final_rows").alias("estimate")), list(by)).select(
        *by, "raw_rows", "final_rows", "estimate",
        (F.abs(F.col("estimate") - F.col("final_rows")) / F.col("final_rows")).alias("off"))
