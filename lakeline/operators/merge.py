"""Upsert into a partitioned Parquet table, and its incremental source."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..session import scratch_dir
from ..sources.fs import Folder, partition_values
from ..sources.layout import laid_out
from ..sources.ledger import ATTEMPTS, NO_VALUE, Conflict, Ledger, Live, Snapshot, read_table  # noqa: F401


def incremental_source(
    source: DataFrame, target: DataFrame | None, ts: str, lookback: str = "10 minutes"
) -> DataFrame:
    """Rows at or after the newest ``ts`` of the target minus ``lookback``.

    Everything when the target is missing or empty. An older row whose payment
    or status changed later is not selected; only a full refresh updates it.
    """
    newest = None if target is None else target.agg(F.max(ts)).first()[0]
    if newest is None:
        return source
    return source.where(F.col(ts) >= F.lit(newest) - F.expr(f"INTERVAL {lookback}"))


def newest_partition(spark: SparkSession, path: str, column: str) -> DataFrame | None:
    """The target rows of the highest partition value: enough to find its newest instant.

    No folder of another partition is listed.
    """
    table = Ledger(spark, path)
    now = table.latest()
    known = [p for p in now.parts() if not p.endswith(f"={NO_VALUE}")]
    return table.read([max(known)], now) if known else None


def newest_instant(spark: SparkSession, path: str, partition: str, ts: str):
    """Newest ``ts`` of the table; ``partition`` must be the date of ``ts``."""
    newest = newest_partition(spark, path, partition)
    return None if newest is None else newest.agg(F.max(ts)).first()[0]


def upsert(
    spark: SparkSession,
    path: str,
    source: DataFrame,
    key: str,
    partition_by: str,
    cluster_by: Sequence[str] = (),
    evolve: bool = True,
    within: Column | None = None,
) -> list[str]:
    """Replace rows with matching ``key``, insert the others; returns the partitions rewritten.

    ``partition_by`` holds dates or plain words, as they appear in folder names.

    Only the partitions that hold a matched key or receive a source row are
    rewritten, and one that loses all its rows is removed, so a key whose
    partition changes is never left behind. Matched keys are searched only in folders whose
    range of keys, as noted when they were written, has a key of the source in it; ``within`` may
    bound the partitions further. New source columns are added (``evolve``). The result is one
    commit; if another writer was first, the upsert is computed again from what that one left.
    """
    table = Ledger(spark, path)
    if not table.versions():
        try:
            return _first_load(table, source, key, partition_by, cluster_by)
        except Conflict:
            pass   # Another writer made the table meanwhile.
    # The source feeds several steps: write it once, in the shared folder.
    staged_path = scratch_dir(spark, "upsert")
    try:
        laid_out(source, (partition_by,)).write.partitionBy(partition_by).parquet(staged_path)
        staged = spark.read.schema(source.schema).parquet(staged_path)
        incoming = partition_values(spark, staged_path, partition_by)
        for attempt in range(ATTEMPTS):
            try:
                return _upsert_once(table, staged, incoming, key, partition_by, cluster_by,
                                    evolve, within)
            except Conflict:
                if attempt == ATTEMPTS - 1:
                    raise
    finally:
        Folder(spark, staged_path).delete()
    return []


def _first_load(table: Ledger, source: DataFrame, key: str, partition_by: str,
                cluster_by: Sequence[str]) -> list[str]:
    """There is nothing to compare with, so the source feeds one step only."""
    written = table.stage(source, (partition_by,), cluster_by, key=key)
    if not written:
        return []
    base = Snapshot(partition_by=(partition_by,))
    table.rewrite(base, written, source.schema, ())
    return sorted({f.part.split("=", 1)[1] for f in written})


def _upsert_once(table: Ledger, staged: DataFrame, incoming: list[str], key: str,
                 partition_by: str, cluster_by: Sequence[str], evolve: bool,
                 within: Column | None) -> list[str]:
    base = table.latest()
    extra = [c for c in staged.columns if base.schema is not None and c not in base.schema.names]
    if extra and not evolve:
        raise ValueError(f"columns not in the table: {extra}")
    # Distinct first: a key the source repeats many times is one row in the joins.
    source_keys = staged.select(key).distinct()
    searched = {f.part for f in may_hold(staged.select(key), key, base.of())}
    touched: set[str] = set()
    if searched:
        target = table.read(searched, base)
        target = target if within is None else target.where(within)
        value = F.coalesce(F.col(partition_by).cast("string"), F.lit(NO_VALUE))
        few = [r[0] for r in staged.select(key).limit(POINT_KEYS + 1).collect()]
        if len(few) <= POINT_KEYS:
            # So few that Parquet looks each of them up in its Bloom filters.
            found = target.where(F.col(key).isin(few))
        else:
            found = target.join(source_keys, key, "left_semi")
        # One value per partition of the table, so the list is short by design.
        touched = {row[0] for row in found.select(value).distinct().collect()}
    affected = sorted({*incoming, *touched})
    if not affected:
        return []
    gone = [f"{partition_by}={v}" for v in affected]
    present = {*base.parts()} & {*gone}
    merged = staged
    if present:
        kept = table.read(present, base).join(source_keys, key, "left_anti")
        merged = kept.unionByName(staged, allowMissingColumns=True)
    written = table.stage(merged, (partition_by,), cluster_by, key=key)
    table.rewrite(base._replace(partition_by=(partition_by,)), written, merged.schema, gone)
    return affected


#: Up to so many keys are looked up as values.
POINT_KEYS = 200
#: Borders between key ranges that a key is compared with at most.
BORDERS = 512


def may_hold(keys: DataFrame, key: str, folders: Sequence[Live]) -> list[Live]:
    """Folders that may hold one of the keys: those whose range has one in it, and those whose
    range is not known.

    The borders of all ranges cut the keys' order into segments. Which of them have a key is
    found in one pass that returns a row per segment. Of very many borders only some are used, so
    that the segments are wider and a few folders more may be named, but never fewer.
    """
    kind = keys.schema[key].dataType
    order = _ordered(kind)
    ranged = [f for f in folders if f.low is not None]
    if order is None or not ranged:
        return list(folders)
    values = sorted({v for f in ranged for v in (f.low, f.high)}, key=order)
    step = -(-len(values) // BORDERS)
    borders = [*values[:-1:step], values[-1]]
    points = F.array(*(F.lit(v).cast(kind) for v in borders))
    at = F.size(F.filter(points, lambda p: p <= F.col(key)))
    hit = {(r["at"], r["on"]) for r in keys.where(F.col(key).isNotNull()).select(
        at.alias("at"), F.array_contains(points, F.col(key)).alias("on")).distinct().collect()}
    places = [order(v) for v in borders]

    def holds(f: Live) -> bool:
        low, high = order(f.low), order(f.high)
        for i, on in hit:
            start = places[i - 1] if i else None
            end = places[i] if i < len(places) else None
            if on and low <= start <= high:
                return True
            # Between two borders, neither included.
            if not on and (end is None or low < end) and (start is not None and high > start):
                return True
        return False

    return [f for f in folders if f.low is None or holds(f)]


def _ordered(kind: T.DataType):
    """How text of a value sorts as Spark sorts the values; nothing for types that aren't keys."""
    if isinstance(kind, T.StringType):
        return lambda text: text.encode()
    if isinstance(kind, T.IntegralType):
        return int
    return None
