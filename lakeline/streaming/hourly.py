"""Speed layer: orders per city and hour (A06, ST13).

Duplicates count here, by design: the sums are taken before deduplication.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..functions import utc_hour
from ..operators.dedup import latest_by
from ..sources.lake import BATCH_COLUMN
from ..sources.ledger import Conflict, Ledger, read_table
from .drain import drain
from .writer import BatchWriter

KEYS = ("city", "hour")
MEASURES = ("total_orders", "total_revenue_vnd", "cancelled_orders")


def _measures():
    return [
        F.count("*").alias("total_orders"),
        F.sum("total_vnd").alias("total_revenue_vnd"),
        F.count_if(F.col("status") == "cancelled").alias("cancelled_orders"),
    ]


def hourly_city_batch(orders: DataFrame) -> DataFrame:
    hour = utc_hour("placed_at").alias("hour")
    return orders.groupBy("city", hour).agg(*_measures())


def hourly_city_stream(orders: DataFrame, delay: str | None = None) -> DataFrame:
    """Running totals per hour window; ``delay`` bounds the state and drops later rows.

    In update mode every batch emits the new totals of the hours it touched.
    """
    stream = orders.withWatermark("placed_at", delay) if delay else orders
    window = F.window("placed_at", "1 hour")
    return (
        stream.groupBy("city", window).agg(*_measures())
        .select("city", F.col("window.start").alias("hour"), *MEASURES)
    )


def drain_hourly_totals(orders: DataFrame, path: str, checkpoint: str,
                        delay: str | None = None) -> list[dict]:
    """Keep running totals in state and store each change as a version of its hour."""
    writer = BatchWriter(path, partition_by=())
    return drain(hourly_city_stream(orders, delay), writer, checkpoint, mode="update")


def read_hourly_totals(spark: SparkSession, path: str) -> DataFrame:
    return latest_by(spark.read.parquet(path), KEYS, BATCH_COLUMN).drop(BATCH_COLUMN)


#: Folders of one level that are merged into one of the next.
FAN = 8


class LevelledSums:
    """``foreachBatch`` target: sums of every batch, merged level by level.

    A batch adds one folder of sums to level 0 of a versioned table, in one commit that also
    notes the batch, so a replay after a crash changes nothing. As soon as a level has ``fan``
    folders they become one folder of the next level, in one commit as well. After n batches
    there are less than ``fan`` folders on each of about log(n) levels, however long the stream
    has run, and a sum was written again about log(n) times.
    """

    def __init__(self, spark: SparkSession, path: str, fan: int = FAN, stream: str = "stream"):
        """``stream`` names the one whose batches are counted; its numbers must not begin anew."""
        if fan < 2:
            raise ValueError("at least two folders make one")
        self.table, self.fan, self.stream = Ledger(spark, path), fan, stream

    def __call__(self, df: DataFrame, batch_id: int) -> None:
        mark = (self.stream, batch_id)
        if not self.table.done(mark, self.table.latest()):
            sums = hourly_city_batch(df)
            self.table.add(self.table.stage(sums, part="level=0"), _levelled(sums.schema),
                           ("level",), mark=mark)
        self.merge()

    def merge(self) -> int:
        """Merge all full levels; returns how many commits that took. A merge that died is made
        again by the next call; one that another writer has made is left to that one."""
        level, merges, now = 0, 0, self.table.latest()
        while level <= max((int(f.part[len("level="):]) for f in now.of()), default=-1):
            folders = [f for f in now.of() if f.part == f"level={level}"]
            if len(folders) >= self.fan:
                sums = _summed(self.table.read(snapshot=now._replace(folders=tuple(folders))))
                staged = self.table.stage(sums, part=f"level={level + 1}")
                try:
                    now = self.table.exchange(folders, staged)
                    merges += 1
                except Conflict:
                    now = self.table.latest()
            level += 1
        return merges


def _levelled(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema, T.StructField("level", T.IntegerType())])


def _summed(partials: DataFrame) -> DataFrame:
    return partials.groupBy(*KEYS).agg(*(F.sum(m).alias(m) for m in MEASURES))


def drain_hourly_levels(orders: DataFrame, path: str, checkpoint: str,
                        fan: int = FAN) -> list[dict]:
    """Like ``drain_hourly_partials``, for streams that go on: what a reader opens is bounded."""
    return drain(orders, LevelledSums(orders.sparkSession, path, fan, checkpoint),
                 checkpoint)


def read_hourly_levels(spark: SparkSession, path: str) -> DataFrame:
    """Totals per city and hour of all batches that have been committed."""
    return _summed(read_table(spark, path))


def drain_hourly_partials(orders: DataFrame, path: str, checkpoint: str) -> list[dict]:
    """Store one partial sum per batch, city and hour: no state, and no row is ever late."""
    writer = BatchWriter(path, partition_by=(), transform=hourly_city_batch)
    return drain(orders, writer, checkpoint)


def read_hourly_partials(spark: SparkSession, path: str) -> DataFrame:
    """Sum the partials per key."""
    return _summed(spark.read.parquet(path))
