"""Replay-safe micro-batch writer (S04, ST04, ST06-ST08, ST12)."""

from __future__ import annotations

import contextlib
import time
from collections.abc import Callable, Iterator, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from ..sources.lake import BATCH_COLUMN, DAY_COLUMNS

#: Files that one micro-batch leaves in a partition folder at most, and rows of one file.
FILES_PER_PARTITION, ROWS_PER_FILE = 4, 2_000_000
#: Rows of a batch from which its partitions are dealt out to more tasks, a task for so many.
ROWS_PER_TASK = 1_000_000
#: Partitions that a task writes side by side. Only a task with more of them sorts its rows.
OPEN_FILES = 4
OPEN_FILES_SETTING = "spark.sql.maxConcurrentOutputFileWriters"
MISSING_CONDITIONS = ("FAILED_READ_FILE.FILE_NOT_EXIST", "PATH_NOT_FOUND")


class TooManySkips(RuntimeError):
    """More batches lost their input than the job tolerates."""


def input_is_gone(error: Exception) -> bool:
    """Whether a file that the batch should read no longer exists.

    Decided by Spark's error condition or the class of a cause, not by the message.
    """
    cause = error.java_exception if isinstance(error, Py4JJavaError) else getattr(
        error, "_origin", None)
    if isinstance(error, PySparkException) and error.getCondition() in MISSING_CONDITIONS:
        return True
    while cause is not None:
        if cause.getClass().getName() == "java.io.FileNotFoundException":
            return True
        if hasattr(cause, "getCondition") and _condition(cause) in MISSING_CONDITIONS:
            return True
        cause = cause.getCause()
    return False


def _condition(cause) -> str | None:
    try:
        return cause.getCondition()
    except Exception:  # a cause that is no Spark error has no condition
        return None


@contextlib.contextmanager
def _open_files(spark: SparkSession) -> Iterator[None]:
    """Writes in here need no sort by partition, which a large batch would spill."""
    before = spark.conf.get(OPEN_FILES_SETTING)
    spark.conf.set(OPEN_FILES_SETTING, str(max(OPEN_FILES, int(before))))
    try:
        yield
    finally:
        spark.conf.set(OPEN_FILES_SETTING, before)


class BatchWriter:
    """``foreachBatch`` target: Parquet partitions with the batch as innermost one.

    A batch that is replayed after a crash overwrites its own partitions, so an append never
    doubles. Rows are counted while they are written; nothing is computed twice. An empty batch
    writes nothing. Rows are dealt out by partition and a few slices of it before they are
    written, so the number of files does not follow the number of shuffle tasks. After a batch of
    many million rows there are more slices, so that a day of the next one is not left to a few
    tasks. ``files`` of None leaves rows where they are, which saves the shuffle of a stream that
    has no other.
    """

    def __init__(
        self,
        path: str,
        partition_by: Sequence[str] = DAY_COLUMNS,
        on_missing: str = "fail",
        max_skips: int = 5,
        transform: Callable[[DataFrame], DataFrame] | None = None,
        files: int | None = FILES_PER_PARTITION,
        rows_per_file: int = ROWS_PER_FILE,
    ):
        self.path = path
        self.partition_by = tuple(partition_by)
        self.on_missing = on_missing
        self.max_skips = max_skips
        self.transform = transform
        self.files = files
        self.rows_per_file = rows_per_file
        self.batches: list[dict] = []
        self.skips = 0

    def _laid_out(self, df: DataFrame) -> DataFrame:
        if self.files is None:
            return df
        last = self.batches[-1]["rows"] if self.batches else 0
        slices = max(self.files, -(-last // ROWS_PER_TASK))
        slice_of = F.pmod(F.xxhash64(*df.columns), F.lit(slices))
        if not self.partition_by:
            return df.repartition(slices, slice_of)
        return df.repartition(*self.partition_by, slice_of)

    def __call__(self, df: DataFrame, batch_id: int) -> None:
        if self.transform:
            df = self.transform(df)
        seen = Observation()
        rows = self._laid_out(df).withColumn(
            BATCH_COLUMN, F.lit(batch_id).cast("bigint")
        ).observe(seen, F.count("*").alias("rows"))
        started = time.perf_counter()
        try:
            with _open_files(df.sparkSession):
                (
                    rows.write.mode("overwrite")
                    .option("partitionOverwriteMode", "dynamic")
                    .option("maxRecordsPerFile", self.rows_per_file)
                    .partitionBy(*self.partition_by, BATCH_COLUMN)
                    .parquet(self.path)
                )
        except (PySparkException, Py4JJavaError) as error:
            if self.on_missing == "fail" or not input_is_gone(error):
                raise
            self._skip(batch_id, error)
            return
        seconds = time.perf_counter() - started
        written = seen.get["rows"]
        if written:
            self.batches.append({
                "batch_id": batch_id, "rows": written, "write_sec": seconds,
                "rows_per_sec": written / seconds,
            })

    def _skip(self, batch_id: int, error: Exception) -> None:
        """The rows of a skipped batch are lost: its offsets are committed all the same."""
        self.skips += 1
        if self.skips > self.max_skips:
            raise TooManySkips(f"{self.skips} batches without input, last {batch_id}") from error


def make_batch_writer(path: str, partition_by: Sequence[str] = DAY_COLUMNS, **options):
    return BatchWriter(path, partition_by, **options)
