"""Event-time deduplication of streams (D01, ST01, ST02)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

#: Slices in which copies of a record meet before they meet as a whole.
SPREAD = 8


def dedup_stream(
    df: DataFrame,
    id: str,
    ts: str = "event_timestamp",
    delay: str = "10 minutes",
    within_watermark: bool = False,
    spread: int = SPREAD,
    slice_by: Column | None = None,
) -> DataFrame:
    """Drop repeated ``(id, ts)`` pairs; rows older than the watermark disappear.

    ``within_watermark`` is the stronger form: one row per ``id`` while its state lasts, whatever
    its time. Copies of one record, which may be a third of the input, are first removed within
    ``spread`` slices of the input, so that few of them meet in one state task; this costs a
    second state store, and 0 leaves it out. ``slice_by`` says where a row came from, its file or
    the task that read it: a task that runs again must deal its rows as before. Without it
    nothing is sliced.
    """
    marked = df.withWatermark(ts, delay)
    if within_watermark:
        return marked.dropDuplicatesWithinWatermark([id])
    if spread > 1 and slice_by is not None:
        slice_of = F.pmod(F.xxhash64(slice_by), F.lit(spread))
        sliced = marked.withColumn("__slice", slice_of)
        marked = sliced.dropDuplicates([id, ts, "__slice"]).drop("__slice")
    return marked.dropDuplicates([id, ts])
