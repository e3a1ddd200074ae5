"""Bounded drains of a stream with checkpointed restart (ST03, ST05, S10, ST09-ST11)."""

from __future__ import annotations

import contextlib
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import with_event_date_parts
from ..schemas import TOPICS, required
from ..session import brief_shuffles
from ..sources.landing import TooManyBadRecords, read_events, split_corrupt
from .dedup import SPREAD, dedup_stream
from .metrics import ProgressLog, store_run, with_stored
from .writer import BatchWriter


#: Tasks that the files of a batch are dealt out to, by core.
TASKS_PER_CORE = 8
MIN_SPLITS = "spark.sql.files.minPartitionNum"
STATE_VERSIONS = "spark.sql.streaming.maxBatchesToRetainInMemory"


@contextlib.contextmanager
def even_scans(spark: SparkSession) -> Iterator[None]:
    """The files of a batch are dealt out to all cores, unless the session has its own number.

    Spark packs files into tasks of 128 MB. Of compressed lines these are so many rows that a
    large batch has hardly more tasks than there are cores, and waits for the last ones. A stream
    looks the number up batch by batch, so this has to last as long as the stream.
    """
    if spark.conf.get(MIN_SPLITS, None) is not None:
        yield
        return
    spark.conf.set(MIN_SPLITS, str(TASKS_PER_CORE * spark.sparkContext.defaultParallelism))
    try:
        yield
    finally:
        spark.conf.unset(MIN_SPLITS)


@contextlib.contextmanager
def one_state_version(spark: SparkSession) -> Iterator[None]:
    """State that is kept on the heap is kept in its newest version only; a batch that runs
    again reads the one before it from the checkpoint."""
    before = spark.conf.get(STATE_VERSIONS)
    spark.conf.set(STATE_VERSIONS, str(min(1, int(before))))
    try:
        yield
    finally:
        spark.conf.set(STATE_VERSIONS, before)


def drain(stream: DataFrame, writer: Callable[[DataFrame, int], None], checkpoint: str,
          mode: str = "append", state_partitions: int | None = None) -> list[dict]:
    """Process what has arrived, then stop; the next call resumes from the checkpoint.

    Returns one record per batch, of all batches of this call. ``state_partitions`` fixes the
    number of state tasks at the first start, where the session's number is not wanted.
    """
    spark = stream.sparkSession
    log = ProgressLog(spark)

    def write(df: DataFrame, batch_id: int) -> None:
        writer(df, batch_id)
        log.batch_done()

    before = spark.conf.get("spark.sql.shuffle.partitions")
    if state_partitions:
        spark.conf.set("spark.sql.shuffle.partitions", str(state_partitions))
    try:
        # The query keeps the settings it was started with.
        with brief_shuffles(spark):
            log.query = (
                stream.writeStream.foreachBatch(write)
                .option("checkpointLocation", checkpoint)
                .trigger(availableNow=True)
                .outputMode(mode)
                .start()
            )
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    log.query.awaitTermination()
    return log.all()


def topic_stream(
    spark: SparkSession,
    topic: str,
    landing: str,
    max_files: int = 50,
    delay: str = "10 minutes",
    within_watermark: bool = False,
    spread: int = SPREAD,
    max_bytes: int | None = None,
) -> DataFrame:
    """Good rows of a topic, deduplicated, with their UTC day columns."""
    schema, key = TOPICS[topic]
    good, _ = split_corrupt(
        read_events(spark, landing, schema, max_files, max_bytes=max_bytes), required(schema)
    )
    # By the task that read them, so by files: a path beside every row costs more than its slice.
    unique = dedup_stream(good, key, "event_timestamp", delay, within_watermark, spread,
                          F.spark_partition_id())
    return with_event_date_parts(unique)


def drain_topic(
    spark: SparkSession,
    topic: str,
    landing: str,
    lake: str,
    checkpoint: str,
    writer: BatchWriter | None = None,
    state_partitions: int | None = None,
    **stream_options,
) -> list[dict]:
    """Good rows of a landing folder to a lake table, once."""
    writer = writer or BatchWriter(lake)
    with even_scans(spark), one_state_version(spark):
        progress = drain(topic_stream(spark, topic, landing, **stream_options), writer, checkpoint,
                         state_partitions=state_partitions)
    return with_stored(progress, writer)


def drain_quarantine(
    spark: SparkSession, topic: str, landing: str, path: str, checkpoint: str, max_files: int = 50,
    max_bytes: int | None = None,
) -> list[dict]:
    """Unusable records of a topic, kept with their reason. Stateless, own checkpoint."""
    schema, _ = TOPICS[topic]
    stream = read_events(spark, landing, schema, max_files, max_bytes=max_bytes)
    _, bad = split_corrupt(stream, required(schema))
    writer = BatchWriter(path, partition_by=())
    return with_stored(drain(bad, writer, checkpoint), writer)


def ingest_topic(
    spark: SparkSession,
    topic: str,
    landing: str,
    lake: str,
    checkpoint: str,
    quarantine: str,
    metrics: str,
    max_bad: int | None = None,
    writer: BatchWriter | None = None,
    max_files: int = 50,
    quarantine_files: int | None = None,
    max_bytes: int | None = None,
    **options,
) -> dict:
    """One run of the ingest job: every landed line ends in the lake, in the quarantine, or in
    the stored counts of late rows and of duplicates.

    The run's record is stored and returned. With ``max_bad`` the run fails beyond that many new
    bad records, after all has been stored.
    """
    writer = writer or BatchWriter(lake)
    batches = drain_topic(spark, topic, landing, lake, checkpoint, writer, max_files=max_files,
                          max_bytes=max_bytes, **options)
    bad = drain_quarantine(spark, topic, landing, quarantine, f"{checkpoint}-quarantine",
                           quarantine_files or max_files, max_bytes)
    quarantined = sum(b["stored_rows"] for b in bad)
    record = store_run(spark, metrics, f"stream-{topic}", batches, quarantined, writer.skips)
    if max_bad is not None and quarantined > max_bad:
        raise TooManyBadRecords(f"{quarantined} bad records in {landing}, kept in {quarantine}")
    return record
