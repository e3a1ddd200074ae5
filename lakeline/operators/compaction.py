"""Small-file compaction of one lake day."""

from __future__ import annotations

import datetime as dt
import math
from typing import NamedTuple

from pyspark.sql import DataFrame, Row, SparkSession, functions as F

from ..sources import swap
from ..sources.fs import Folder, as_date
from ..sources.lake import BATCH_COLUMN
from ..sources.ledger import Ledger

TARGET_BYTES = 128 * 2**20
COMPACTED_BATCH = -1


class Compaction(NamedTuple):
    rows: int
    files_before: int
    files_after: int
    skipped: str | None = None


def compact(
    spark: SparkSession, base: str, date: str | dt.date, target_bytes: int = TARGET_BYTES
) -> Compaction:
    """Rewrite a day into files of about ``target_bytes``, keeping every row.

    The number of output files follows from the bytes of the day, so merging
    read splits with ``coalesce`` needs no shuffle and no task handles more
    than about one output file. The result is written beside the table, its
    row count and the sum of its row hashes are compared with those of the day, and
    only then the day is swapped. Run it on closed days.
    """
    swap.recover(spark, base)
    d = as_date(date)
    part = f"year={d.year}/month={d.month}/day={d.day}"
    day = Folder(spark, base).child(part)
    if not day.exists():
        return Compaction(0, 0, 0, "no_data")
    sizes = day.file_sizes()
    size, files = sum(sizes), len(sizes)
    if not files:
        return Compaction(0, 0, 0, "no_data")
    rows = spark.read.parquet(day.path)
    columns = [c for c in rows.columns if c != BATCH_COLUMN]
    before = _content(rows, columns)
    if before.n == 0:
        return Compaction(0, files, files, "empty")
    wanted = max(1, math.ceil(size / target_bytes))
    tiny = sum(n < target_bytes / 8 for n in sizes)
    if files <= wanted and (files == 1 or 2 * tiny <= files):
        return Compaction(before.n, files, files, "already_compact")

    work = swap.open_swap(spark, base)
    target = work.child("new").child(part)
    by_batch = any(n.startswith(f"{BATCH_COLUMN}=") for n in day.names())
    if by_batch:
        rows = rows.drop(BATCH_COLUMN)
        target = target.child(f"{BATCH_COLUMN}={COMPACTED_BATCH}")
    rows.coalesce(wanted).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false"
                                       ).parquet(target.path)
    after = _content(spark.read.parquet(target.path), columns)
    if after != before:
        work.delete()
        raise RuntimeError(f"compaction of {day.path} wrote {after}, not {before}")
    swap.commit(work, Folder(spark, base), [part])
    return Compaction(before.n, files, len(day.file_sizes()))


def compact_table(
    spark: SparkSession, path: str, part: str = "", target_bytes: int = TARGET_BYTES,
    key: str | None = None,
) -> Compaction:
    """Rewrite a partition of a versioned table (the whole one, if it has no partitions) into
    files of about ``target_bytes``, as one commit.

    The old folders stay until a vacuum, so readers of older versions are not disturbed, and a
    writer that replaces the partition meanwhile makes the compaction fail with ``Conflict``;
    rows that one adds stay.
    """
    table = Ledger(spark, path)
    base = table.latest()
    live = [f for f in base.of() if f.part == part]
    if not live:
        return Compaction(0, 0, 0, "no_data")
    sizes = [n for f in live for n in table.folder_of(f).file_sizes()]
    wanted = max(1, math.ceil(sum(sizes) / target_bytes))
    df = table.read([part], base)
    columns = [c for c in df.columns if c not in base.partition_by]
    before = _content(df, columns)
    if len(sizes) <= wanted:
        return Compaction(before.n, len(sizes), len(sizes), "already_compact")
    staged = table.stage(df.select(columns).coalesce(wanted), key=key, part=part or None)
    after = _content(table.read([part], base._replace(folders=tuple(staged))), columns)
    if after != before:
        raise RuntimeError(f"compaction of {path} {part} wrote {after}, not {before}")
    table.exchange(live, staged)
    files = sum(len(table.folder_of(f).file_sizes()) for f in staged)
    return Compaction(before.n, len(sizes), files)


def _content(df: DataFrame, columns: list[str]) -> Row:
    """Row count and sum of the row hashes, in one pass; no order of rows changes them."""
    row_hash = F.xxhash64(*(F.col(f"`{c}`") for c in columns)).cast("decimal(38,0)")
    return df.agg(F.count("*").alias("n"), F.sum(row_hash).alias("h")).first()
