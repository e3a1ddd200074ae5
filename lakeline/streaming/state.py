"""What a checkpoint holds: its batches and the keys of its stateful operators (ST05, ST12)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..sources.fs import Folder


def state_operators(spark: SparkSession, checkpoint: str) -> DataFrame:
    """Per operator of the newest batch: operator_id, operator, store, partitions, and the first
    and last batch whose state can still be read."""
    return spark.read.format("state-metadata").load(checkpoint).select(
        F.col("operatorId").alias("operator_id"), F.col("operatorName").alias("operator"),
        F.col("stateStoreName").alias("store"), F.col("numPartitions").alias("partitions"),
        F.col("minBatchId").alias("first_batch"), F.col("maxBatchId").alias("last_batch"))


def state_keys(spark: SparkSession, checkpoint: str, operator_id: int = 0,
               batch_id: int | None = None) -> DataFrame:
    """The keys that an operator remembers after a batch, the newest if none is given: the
    columns of the key and partition_id, in which state task it is."""
    reader = spark.read.format("statestore").option("operatorId", operator_id)
    if batch_id is not None:
        reader = reader.option("batchId", batch_id)
    return reader.load(checkpoint).select("key.*", "partition_id")


def open_batches(spark: SparkSession, checkpoint: str) -> list[int]:
    """Batches that were begun and not committed: a restart makes them again."""
    begun, done = ({int(n) for n in Folder(spark, f"{checkpoint}/{name}").names() if n.isdigit()}
                   for name in ("offsets", "commits"))
    return sorted(begun - done)
