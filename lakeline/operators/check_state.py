"""Check results kept per partition, so that a run looks at changed partitions only (Q01-Q07).

Row-level failures add up over partitions. Uniqueness does not; of it the state keeps the keys
that are, or were, in the table more than once, with their rows per partition. That table is small
where data is sound, and it is all that a change of some partitions has to be combined with, next
to the keys of those other partitions whose range of keys says that they may share one.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..sources.ledger import Ledger, Snapshot
from .merge import may_hold
from .quality import Check

RESULTS = "check_name string, column_name string, failures bigint"
REPEATED = "repeated"


def changed_parts(table: Ledger, now: Snapshot, since: int | None) -> set[str]:
    """Partitions whose folders differ from those of version ``since``; all, if that is gone."""
    if since is None or since not in table.versions():
        return set(now.parts())
    differ = set(now.of()) ^ set(table.at(since).of())
    return {f.part for f in differ}


def check_changes(spark: SparkSession, path: str, state_path: str, key: str,
                  checks: Sequence[Check]) -> set[str]:
    """Bring the results at ``state_path`` up to date with the versioned table at ``path``, which
    has one partition column of dates or plain words, and return the partitions looked at.

    The new results are one commit that names the version they hold for, so a run that dies has
    done nothing, and the next one does it. Other checks than last time are made on all partitions.
    """
    table, state = Ledger(spark, path), Ledger(spark, state_path)
    now, held = table.latest(), state.latest()
    listed = zlib.crc32(json.dumps([key, [(c.name, c.column, str(c.fails)) for c in checks]]).encode())
    same = held.marks.get("checks") == listed
    changed = changed_parts(table, now, held.marks.get("version") if same else None)
    if not same:
        changed |= set(held.parts())
    if not changed and same:
        return set()
    (column,) = now.partition_by
    rows = table.read(changed, now)
    staged = state.stage(_failures(rows, column, checks), (column,))
    staged += state.stage(_repeated(table, now, rows, changed, column, key), (column,),
                          kind=REPEATED)
    schema = T.StructType([*T.StructType.fromDDL(RESULTS), now.schema[column]])

    def change(base: Snapshot) -> Snapshot:
        if base != held:
            return base  # another run was first; its results are as good
        new = state._with(base, schema, (column,), staged, changed, ("data", REPEATED))
        return new._replace(marks={"version": now.version, "checks": listed})

    state.commit(change)
    return changed


def _failures(rows: DataFrame, column: str, checks: Sequence[Check]) -> DataFrame:
    """Failures of every check in each partition, in one pass."""
    counts = rows.groupBy(column).agg(
        F.count("*").alias("rows"),
        *(F.count_if(c.fails).alias(f"c{i}") for i, c in enumerate(checks)))
    results = [F.struct(F.lit(c.name).alias("check_name"), F.lit(c.column).alias("column_name"),
                        F.col(f"c{i}").alias("failures")) for i, c in enumerate(checks)]
    total = F.struct(F.lit("rows").alias("check_name"), F.lit("").alias("column_name"),
                     F.col("rows").alias("failures"))
    return counts.select(column, F.inline(F.array(total, *results)))


def _repeated(table: Ledger, now: Snapshot, rows: DataFrame, changed: set[str], column: str,
              key: str) -> DataFrame:
    """Keys that the changed partitions share among each other, with themselves or with others:
    partition, key as text, and rows of the key there."""
    counts = rows.where(F.col(key).isNotNull()).groupBy(column, key).agg(F.count("*").alias("n"))
    others = {f.part for f in may_hold(rows.select(key), key,
                                       [f for f in now.of() if f.part not in changed])}
    if others:
        met = table.read(others, now).join(rows.select(key).distinct(), key, "left_semi")
        counts = counts.unionByName(
            met.groupBy(column, key).agg(F.count("*").alias("n")))
    often = counts.groupBy(key).agg(F.sum("n").alias("all")).where("all > 1").select(key)
    return counts.join(often, key, "left_semi").select(
        column, F.col(key).cast("string").alias("key"), "n")


def check_report(spark: SparkSession, state_path: str, key: str) -> DataFrame:
    """check_name, column_name, failures of the whole table, from the state alone."""
    state = Ledger(spark, state_path)
    now = state.latest()
    if not now.version:
        return spark.createDataFrame([], RESULTS)
    results = state.read(snapshot=now).where("check_name <> 'rows'").groupBy(
        "check_name", "column_name").agg(F.sum("failures").alias("failures"))
    (column,) = now.partition_by
    repeated = state.read(snapshot=now, kind=REPEATED, schema=T.StructType([
        T.StructField("key", T.StringType()), T.StructField("n", T.LongType()),
        now.schema[column]]))
    # Several runs may have noted the same rows of an unchanged partition.
    per_key = repeated.groupBy(column, "key").agg(F.max("n").alias("n")).groupBy("key").agg(
        F.sum("n").alias("n"))
    unique = per_key.where("n > 1").agg(F.count("*").alias("failures")).select(
        F.lit("unique").alias("check_name"), F.lit(key).alias("column_name"), "failures")
    return results.unionByName(unique)
