"""How rows are laid out before they are written."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def laid_out(
    df: DataFrame, partition_by: Sequence[str] = (), cluster_by: Sequence[str] = ()
) -> DataFrame:
    """Group rows by partition and sort them by cluster columns for writing.

    ``rebalance`` lets adaptive execution cut a heavy partition into several
    tasks and merge light ones, where ``repartition`` would put a heavy day
    into one task. Sorted files carry tight min/max values for skipping.
    """
    order = [*partition_by, *cluster_by]
    if not order:
        return df
    grouped = df.hint("rebalance", *[F.col(c) for c in partition_by or cluster_by])
    return grouped.sortWithinPartitions(*order)
