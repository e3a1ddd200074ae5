"""What a drain did, batch by batch and as a whole (S06, ST02, ST09)."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession

from .writer import BatchWriter

BATCH_FIELDS = ("job string, run_id string, batch_id bigint, input_rows bigint, "
                "rows_per_sec double, duration_ms bigint, late_rows bigint, "
                "duplicate_rows bigint, state_rows bigint, stored_rows bigint, write_sec double")
RUN_FIELDS = ("job string, run_id string, ended_at timestamp, batches bigint, input_rows bigint, "
              "stored_rows bigint, late_rows bigint, duplicate_rows bigint, "
              "quarantined_rows bigint, skipped_batches bigint")


def progress_record(progress) -> dict:
    operators = progress["stateOperators"]
    return {
        "batch_id": progress["batchId"],
        "input_rows": progress["numInputRows"],
        "rows_per_sec": float(progress["processedRowsPerSecond"] or 0.0),
        "duration_ms": progress["durationMs"].get("triggerExecution", 0),
        "late_rows": sum(op["numRowsDroppedByWatermark"] for op in operators),
        "duplicate_rows": sum(
            op["customMetrics"].get("numDroppedDuplicateRows", 0) for op in operators),
        "state_rows": sum(op["numRowsTotal"] for op in operators),
    }


class ProgressLog:
    """Progress of every batch of a query.

    Spark keeps the newest few only. The log is read again before as many batches have passed
    as Spark keeps, so none is missed however many there are.
    """

    def __init__(self, spark: SparkSession):
        kept = int(spark.conf.get("spark.sql.streaming.numRecentProgressUpdates"))
        self.every = max(1, kept // 2)
        self.query = None
        self.calls = 0
        self.records: dict[int, dict] = {}

    def batch_done(self) -> None:
        self.calls += 1
        if self.query is not None and self.calls % self.every == 0:
            self.read()

    def read(self) -> None:
        for progress in self.query.recentProgress:
            # An idle trigger repeats the number of the batch that is to come.
            record = progress_record(progress)
            if record["batch_id"] not in self.records or record["input_rows"]:
                self.records[record["batch_id"]] = record

    def all(self) -> list[dict]:
        self.read()
        return [self.records[i] for i in sorted(self.records)]


def with_stored(progress: list[dict], writer: BatchWriter) -> list[dict]:
    """Batches with the rows their writer stored and the seconds that took."""
    written = {b["batch_id"]: b for b in writer.batches}
    return [{**p, "stored_rows": written.get(p["batch_id"], {}).get("rows", 0),
             "write_sec": written.get(p["batch_id"], {}).get("write_sec", 0.0)}
            for p in progress]


def run_record(job: str, run_id: str, batches: list[dict], quarantined: int, skips: int) -> dict:
    total = lambda name: sum(b[name] for b in batches)
    return {
        "job": job, "run_id": run_id, "ended_at": dt.datetime.now(dt.timezone.utc),
        "batches": len(batches), "input_rows": total("input_rows"),
        "stored_rows": total("stored_rows"), "late_rows": total("late_rows"),
        "duplicate_rows": total("duplicate_rows"), "quarantined_rows": quarantined,
        "skipped_batches": skips,
    }


def batch_rows(spark: SparkSession, job: str, batches: list[dict], run_id: str = "") -> DataFrame:
    return spark.createDataFrame([{"job": job, "run_id": run_id, **b} for b in batches],
                                 BATCH_FIELDS)


def store_run(spark: SparkSession, path: str, job: str, batches: list[dict], quarantined: int = 0,
              skips: int = 0) -> dict:
    """Append a run to ``path``/runs and its batches to ``path``/batches."""
    record = run_record(job, uuid.uuid4().hex, batches, quarantined, skips)
    if batches:
        batch_rows(spark, job, batches, record["run_id"]).coalesce(1).write.mode("append").parquet(
            f"{path}/batches")
    spark.createDataFrame([record], RUN_FIELDS).coalesce(1).write.mode("append").parquet(
        f"{path}/runs")
    return record


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RUN_FIELDS).parquet(f"{path}/runs")


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(BATCH_FIELDS).parquet(f"{path}/batches")
