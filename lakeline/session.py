"""Session settings every job shares, and the shared scratch folder."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import SparkSession

#: Only what the results or the scaling of every job depend on. Executor
#: sizes, parallelism and storage connectors belong to the deployment.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # State lives outside the heap, so dedup state may exceed executor memory,
    # and only the changes of a batch are uploaded.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def build_session(app_name: str, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> SparkSession:
    """All instants are UTC; local clocks are derived columns, not a session setting."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextlib.contextmanager
def brief_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of every statement begun in here go as soon as it ends, and not when the
    driver next collects garbage. A DataFrame that is run twice is shuffled twice."""
    before = spark.conf.get(SHUFFLE_CLEANUP)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new folder below the shared checkpoint folder of the cluster.

    The cluster names that folder in ``spark.checkpoint.dir``. Only a local
    session without the setting, as in unit tests, gets one of its own.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="lakeline-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/lakeline/{name}-{uuid.uuid4().hex}"
