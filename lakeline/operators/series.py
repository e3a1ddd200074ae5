"""Operational series: backlog alerts, counter rates, gauges."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import scratch_dir

CHUNK = "__chunk"
UNIT_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}


def _range_chunks(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows marked with consecutive chunks of the order of ``columns``.

    Chunks hold about the same number of rows whatever the distribution, so a
    series with a third of all samples is spread over a third of the chunks.
    They are stored in the shared folder, which fixes them for all later steps.
    """
    spark, path = df.sparkSession, scratch_dir(df.sparkSession, "chunks")
    chunked = df.repartitionByRange(*columns).withColumn(CHUNK, F.spark_partition_id())
    chunked.write.parquet(path)
    return spark.read.schema(chunked.schema).parquet(path)


def with_previous(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    value: str,
    tie: Sequence[str] = (),
    bucket: str | None = None,
    names: tuple[str, str] = ("previous", "previous_ts"),
) -> DataFrame:
    """Value and time of the preceding sample of the same series.

    A plain ``lag`` would sort a whole series in one task. Here each
    (series, chunk) is a window of its own, and only the last sample of every
    chunk, combined on the map side, is carried over to the next one. Chunks
    are equal ranges of the data, or time units when ``bucket`` names one,
    which suits evenly sampled series and stays lazy.
    """
    order = [ts, *tie]
    if bucket:
        binned = df.withColumn(CHUNK, F.date_trunc(bucket, ts))
    else:
        binned = _range_chunks(df, [*keys, *order])
    sample = F.struct(F.col(value).alias("v"), F.col(ts).alias("t"))
    within = Window.partitionBy(*keys, CHUNK).orderBy(*order)
    lagged = binned.withColumns({
        "__prev": F.lag(sample).over(within),
        "__first": F.row_number().over(within) == 1,
    })
    ends = binned.groupBy(*keys, CHUNK).agg(
        F.max_by(sample, F.struct(*order)).alias("__last"), F.min(ts).alias("__from"),
    )
    across = Window.partitionBy(*keys).orderBy("__from", CHUNK)
    carried = ends.select(
        *(F.col(k).alias(f"__key{i}") for i, k in enumerate(keys)),
        F.col(CHUNK).alias("__of"), F.lag("__last").over(across).alias("__carry"))
    # A series without a name is a series too, hence the null-safe comparison.
    same = lagged[CHUNK].eqNullSafe(carried["__of"])
    for i, k in enumerate(keys):
        same = same & lagged[k].eqNullSafe(carried[f"__key{i}"])
    joined = lagged.join(carried, same, "left")
    source = F.when(F.col("__first"), F.col("__carry")).otherwise(F.col("__prev"))
    return joined.select(
        *df.columns, source.getField("v").alias(names[0]), source.getField("t").alias(names[1])
    )


def backlog_alerts(
    samples: DataFrame,
    high: int = 50_000,
    floor: int = 5_000,
    tie: Sequence[str] = (),
    bucket: str | None = None,
) -> DataFrame:
    """HIGH above ``high``; GROWING when the previous sample was above ``floor`` and it rose."""
    seen = with_previous(samples, ["subscription"], "ts", "backlog", tie, bucket,
                         ("previous_backlog", "previous_ts"))
    current, previous = F.col("backlog"), F.coalesce(F.col("previous_backlog"), F.lit(0))
    alerts = F.array_compact(F.array(
        F.when(current > high, F.lit("HIGH_BACKLOG")),
        F.when((previous > floor) & (current > previous), F.lit("GROWING_BACKLOG")),
    ))
    return seen.select(*samples.columns, "previous_backlog", F.explode(alerts).alias("alert"))


class BacklogAlerts(RuntimeError):
    """Backlogs that somebody has to look at."""


def assert_no_backlog(samples: DataFrame, high: int = 50_000, floor: int = 5_000,
                      tie: Sequence[str] = ()) -> int:
    """Fail if the newest sample of a subscription raises an alert; returns the number of
    subscriptions. The message names the first twenty."""
    newest = samples.groupBy("subscription").agg(F.max("ts").alias("ts"))
    alerts = backlog_alerts(samples, high, floor, tie).join(newest, ["subscription", "ts"])
    found = alerts.orderBy("subscription", "alert").limit(20).collect()
    if found:
        raise BacklogAlerts("; ".join(
            f"{r['subscription']}: {r['alert']} {r['backlog']} (before: {r['previous_backlog']})"
            for r in found))
    return newest.count()


def counter_increase(
    samples: DataFrame, series: Sequence[str], tie: Sequence[str] = (), bucket: str | None = None
) -> DataFrame:
    """Growth of a counter since its previous sample; a drop means it restarted from 0."""
    seen = with_previous(samples, series, "ts", "value", tie, bucket)
    v, p = F.col("value"), F.col("previous")
    grown = F.when(p.isNotNull(), F.when(v >= p, v - p).otherwise(v))
    elapsed = (F.unix_micros("ts") - F.unix_micros("previous_ts")) / F.lit(1e6)
    return seen.select(
        *samples.columns, grown.alias("increase"), elapsed.alias("elapsed_seconds")
    )


def counter_rate(
    samples: DataFrame,
    series: Sequence[str],
    label: Sequence[str],
    window: str = "1 minute",
    tie: Sequence[str] = (),
    bucket: str | None = None,
) -> DataFrame:
    """Increase per second in each time window, summed over the series of a label."""
    amount, unit = window.split()
    seconds = F.lit(float(amount) * UNIT_SECONDS[unit.rstrip("s")])
    increases = counter_increase(samples, series, tie, bucket)
    return (
        increases.where(F.col("increase").isNotNull())
        .groupBy(*label, F.window("ts", window).alias("w"))
        .agg(F.sum("increase").alias("increase"))
        .select(
            *label, F.col("w.start").alias("window_start"), "increase",
            (F.col("increase") / seconds).alias("rate"),
        )
    )


def range_rate(
    samples: DataFrame,
    series: Sequence[str],
    label: Sequence[str],
    window: str = "1 minute",
    step: str = "15 seconds",
    tie: Sequence[str] = (),
    bucket: str | None = None,
) -> DataFrame:
    """Rate of counters at steps, each over the ``window`` before it, summed by label.

    ``evaluated_at`` are multiples of ``step``; a window is open at its start and includes its end. A
    series counts where it has two samples in the window. Its growth, resets included, is that
    from its first sample to its last; it is extended to an end of the window that is nearer
    than 1.1 times the mean distance of samples, else by half that distance, and at the start not
    beyond the point where the counter would have been 0. ``series`` is the number of series.

    A sample takes part in window / step windows. What a window needs (ends, growth, count) is
    summed on the map side, so a series of any length is never sorted in one task for it.
    """
    (amount, unit), micro = window.split(), F.expr("INTERVAL 1 MICROSECOND")
    seconds = float(amount) * UNIT_SECONDS[unit.rstrip("s")]
    seen = with_previous(samples.where(F.col("value").isNotNull()), series, "ts", "value", tie,
                         bucket)
    grain = list(dict.fromkeys([*label, *series]))
    # Spark's windows include their start; a microsecond earlier, the end is included.
    windows = seen.select(*grain, "ts", *tie, "value", "previous", "previous_ts",
                          F.window(F.col("ts") - micro, window, step).alias("w"))
    order, start = F.struct("ts", *tie), F.col("w.start") + micro
    reset = (F.col("previous_ts") >= start) & (F.col("value") < F.col("previous"))
    ends = windows.groupBy(*grain, "w").agg(
        F.count("*").alias("n"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"),
        F.min_by("value", order).alias("first"), F.max_by("value", order).alias("last"),
        F.sum(F.when(reset, F.col("previous")).otherwise(F.lit(0.0))).alias("lost"))

    def between(a, b):
        return (F.unix_micros(b) - F.unix_micros(a)) / F.lit(1e6)

    found = ends.where((F.col("n") > 1) & (F.col("last_ts") > F.col("first_ts"))).select(
        *grain, F.col("w.end").alias("evaluated_at"), "first",
        (F.col("last") - F.col("first") + F.col("lost")).alias("increase"),
        between(F.col("first_ts"), F.col("last_ts")).alias("span"),
        between(F.col("w.start"), F.col("first_ts")).alias("before"),
        between(F.col("last_ts"), F.col("w.end")).alias("after"),
        (between(F.col("first_ts"), F.col("last_ts")) / (F.col("n") - 1)).alias("mean"))

    def reach(gap: str) -> Column:
        return F.when(F.col(gap) < F.col("mean") * 1.1, F.col(gap)).otherwise(F.col("mean") / 2)

    to_zero = F.when((F.col("increase") > 0) & (F.col("first") >= 0),
                     F.col("span") * (F.col("first") / F.col("increase")))
    extended = F.col("span") + F.least(reach("before"), to_zero) + reach("after")
    rate = F.col("increase") * (extended / F.col("span")) / F.lit(seconds)
    return found.withColumn("rate", rate).groupBy(*label, "evaluated_at").agg(
        F.count("*").alias("series"), F.sum("rate").alias("rate"))


def instant_rate(samples: DataFrame, series: Sequence[str], **options) -> DataFrame:
    """Rate between neighbouring samples."""
    increases = counter_increase(samples, series, **options)
    rate = F.try_divide(F.col("increase"), F.col("elapsed_seconds"))
    return increases.withColumn("rate", rate)


def gauge_rollup(
    samples: DataFrame, label: Sequence[str], window: str = "5 minutes", value: str = "value"
) -> DataFrame:
    """Mean, extremes and sample count of a gauge per label and time window."""
    return (
        samples.groupBy(*label, F.window("ts", window).alias("w"))
        .agg(F.avg(value).alias("avg_value"), F.min(value).alias("min_value"),
             F.max(value).alias("max_value"), F.count(value).alias("samples"))
        .select(*label, F.col("w.start").alias("window_start"),
                "avg_value", "min_value", "max_value", "samples")
    )


def latest_sum(
    samples: DataFrame, series: Sequence[str], label: Sequence[str], window: str = "5 minutes",
    tie: Sequence[str] = (),
) -> DataFrame:
    """Last value of every series in a window, summed by label (lag by consumer group)."""
    grain = list(dict.fromkeys([*label, *series]))
    last = samples.groupBy(*grain, F.window("ts", window).alias("w")).agg(
        F.max_by("value", F.struct("ts", *tie)).alias("value")
    )
    return last.groupBy(*label, F.col("w.start").alias("window_start")).agg(
        F.sum("value").alias("value")
    )


def used_percent(free: Column, total: Column) -> Column:
    """Share in use, from what is free: 100 - idle, or used memory."""
    return (F.lit(1.0) - F.try_divide(free, total)) * F.lit(100.0)
