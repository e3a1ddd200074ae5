"""Left join that stays balanced when keys own much of the right side."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..session import scratch_dir

#: Rows of one key that one task of the join should take; a key with more is cut.
SLICE_ROWS = 5_000_000
#: Groups of keys that are counted first, where a key has to be larger than a group usually is.
KEY_GROUPS = 65_536


def hot_keys(df: DataFrame, key: str, slice_rows: int = SLICE_ROWS) -> DataFrame | None:
    """(key, slices) of every key with ``slice_rows`` rows or more; None if there is none.

    Reads one column and combines on the map side. Keys are first counted by a hash: a key with
    ``slice_rows`` rows is in a group with as many, so if no group has them nothing else is
    shuffled than the groups' counts. The list is a table in the shared folder, not
    a value of the driver: it may be of any length, and the planner knows its size.
    """
    keyed = df.where(F.col(key).isNotNull()).select(key)
    if slice_rows >= KEY_GROUPS:
        group = F.pmod(F.xxhash64(F.col(key)), F.lit(KEY_GROUPS))
        sizes = keyed.groupBy(group.alias("g")).agg(F.count("*").alias("n"))
        large = [r.g for r in sizes.where(F.col("n") >= slice_rows).select("g").collect()]
        if not large:
            return None
        keyed = keyed.where(group.isin(large))
    counts = keyed.groupBy(key).agg(F.count("*").alias("n"))
    heavy = counts.where(F.col("n") >= slice_rows).select(
        key, F.ceil(F.col("n") / slice_rows + 1).cast("int").alias("slices"))
    path = scratch_dir(df.sparkSession, "hot-keys")
    heavy.write.parquet(path)
    stored = df.sparkSession.read.schema(heavy.schema).parquet(path)
    return None if stored.isEmpty() else stored


def left_join(
    left: DataFrame,
    right: DataFrame,
    on: str | Sequence[str],
    hot: DataFrame | None = None,
) -> DataFrame:
    """``left LEFT JOIN right``, where few rows of ``left`` share a key.

    Adaptive execution may split only the preserved side of an outer join, so a hot key on the
    right would end in one task. ``hot`` lists such keys (see ``hot_keys``; its key is one of
    the join columns). Their right rows are dealt out to slices by a hash of the row, and
    their left rows go to every slice that has some. Without hot keys this is the plain join.
    """
    columns = [on] if isinstance(on, str) else list(on)
    if hot is None:
        return left.join(right, columns, "left")
    key = hot.columns[0]
    cold = left.join(hot, key, "left_anti").join(right.join(hot, key, "left_anti"), columns, "left")
    hot_left, hot_right = left.join(hot, key), right.join(hot, key)
    dealt = F.pmod(F.xxhash64(*(F.col(f"`{c}`") for c in right.columns)), F.col("slices"))
    sliced_right = hot_right.withColumn("__slice", dealt.cast("int")).drop("slices")
    # Grouping combines on the map side, so a hot key has one row per slice here. A left row
    # without any has no slice, finds nothing, and stays once.
    taken = sliced_right.groupBy(*columns, "__slice").agg(F.count("*").alias("n")).drop("n")
    sliced_left = hot_left.drop("slices").join(taken, columns, "left")
    found = sliced_left.join(sliced_right, [*columns, "__slice"], "left")
    return cold.unionByName(found.select(*cold.columns))
