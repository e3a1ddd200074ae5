"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator."""

from __future__ import annotations

import datetime as dt
import math
from collections.abc import Callable
from functools import wraps

from pyspark.errors import StreamingQueryException
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import readable_quantity, utc_datetime, with_event_date_parts
from ..operators import check_state, merge, quality, series, sketches
from ..operators.compaction import compact
from ..operators.dedup import duplicate_report, latest_by, replacing_read
from ..operators.joins import hot_keys
from ..plans import daily, dashboards, intermediate, items, reports, staging
from ..plans.checks import model_checks
from ..plans.incremental import run_incremental
from ..plans.models import run_models
from ..schemas import (
    ORDER_STATUSES, ORDERS, PAYMENT_METHODS, PAYMENTS, RIDER_STATUSES, TOPICS,
)
from ..session import brief_shuffles, scratch_dir, use_utc
from ..sources import adapters, landing, lake, tables, typed
from ..sources.fs import Folder
from ..sources.ledger import Ledger, read_table
from ..streaming import hourly, state
from ..streaming.drain import drain, drain_quarantine, drain_topic, ingest_topic
from ..streaming.metrics import batch_rows, read_runs, store_run
from ..streaming.writer import BatchWriter

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

AS_OF = dt.datetime(2024, 1, 15)                       # UTC
RANGE = (dt.datetime(2024, 1, 3, 0), dt.datetime(2024, 1, 10, 23))   # local, inclusive
LOCAL_NOW = dt.datetime(2024, 1, 15, 7)
LOAD_DATE = dt.date(2024, 1, 20)
BATCHES = 8   # micro-batches of a drain, about
FEED_DELAY = "1 day"   # the landed feed is in order from day to day, but not within one
SHIFT_DAYS = 7


def query(fn: Query) -> Query:
    @wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(use_utc(spark), sf_dir)

    QUERIES[fn.__name__] = run
    return run


# --- models ---------------------------------------------------------------

JOINED = ("int_order_payments", "fct_orders", "dim_restaurant", "rpt_hourly_revenue")


def model(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    raw = adapters.raw_tables(spark, sf_dir)
    return run_models(spark, raw, split_hot_orders=name in JOINED)[name]


def _model_query(name: str) -> None:
    def run(spark, sf_dir):
        return model(spark, sf_dir, name)

    run.__name__ = name
    query(run)


for _name in ("stg_orders", "stg_payments", "stg_riders", "int_order_payments",
              "int_delivery_metrics", "fct_orders", "dim_restaurant", "dim_rider",
              "rpt_hourly_revenue"):
    _model_query(_name)


@query
def int_order_payments_split(spark, sf_dir):
    """The same rows where every order with two payment records or more counts as hot."""
    raw = adapters.raw_tables(spark, sf_dir)
    hot = hot_keys(raw["payments"], "order_id", slice_rows=2)
    return intermediate.int_order_payments(
        staging.stg_orders(raw["orders"]), staging.stg_payments(raw["payments"]), hot)


@query
def daily_summary_split(spark, sf_dir):
    payments = adapters.raw_payments(spark, sf_dir)
    return daily.daily_summary_backfill(
        adapters.raw_orders(spark, sf_dir), payments,
        hot_orders=hot_keys(payments, "order_id", slice_rows=2),
    ).drop("processed_at")


@query
def stg_order_items(spark, sf_dir):
    return staging.stg_order_items(adapters.raw_item_orders(spark, sf_dir))


@query
def stg_order_items_variant(spark, sf_dir):
    """Item texts behind a line break, one item of each with a field that the model does not know."""
    raw = adapters.raw_item_orders(spark, sf_dir)
    changed = F.concat(F.lit("\n\t"), F.replace(
        "items", F.lit('"price_vnd":"'), F.lit('"gift":true,"price_vnd":"')))
    return items.stg_order_items_variant(raw.withColumn("items", changed))


@query
def item_rejects(spark, sf_dir):
    return items.item_rejects(adapters.raw_item_orders(spark, sf_dir))


@query
def int_order_payments_bucketed(spark, sf_dir):
    """Staged orders and payments in buckets of order_id; their join has no shuffle."""
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return run_models(spark, adapters.raw_tables(spark, sf_dir), buckets=buckets)[
        "int_order_payments"]


@query
def models_as_tables(spark, sf_dir):
    """The hourly report from a run that writes its marts as tables."""
    raw = adapters.raw_tables(spark, sf_dir)
    return run_models(spark, raw, scratch_dir(spark, "marts"))["rpt_hourly_revenue"]


# --- daily batch ----------------------------------------------------------

RUN_1, RUN_2 = "2024-01-20 01:00:00", "2024-01-20 02:00:00"


def _stamp(text: str):
    return F.lit(text).cast("timestamp")


@query
def daily_summary(spark, sf_dir):
    payments = adapters.raw_payments(spark, sf_dir)
    return daily.daily_summary_backfill(
        adapters.raw_orders(spark, sf_dir), payments, hot_orders=hot_keys(payments, "order_id")
    ).drop("processed_at")


@query
def daily_summary_latest(spark, sf_dir):
    """Two stored runs, the first before any payment had arrived."""
    orders, payments = adapters.raw_orders(spark, sf_dir), adapters.raw_payments(spark, sf_dir)
    path = scratch_dir(spark, "daily")
    early = daily.daily_summary_backfill(orders, payments.where(F.lit(False)), _stamp(RUN_1))
    late = daily.daily_summary_backfill(orders, payments, _stamp(RUN_2))
    early.unionByName(late).write.partitionBy("batch_date").parquet(path)
    return daily.latest_daily_summary(spark.read.schema(late.schema).parquet(path))


@query
def sink_overwrite_idempotent(spark, sf_dir):
    path = scratch_dir(spark, "daily")
    for _ in range(2):
        lake.overwrite_partitions(daily_summary(spark, sf_dir), path, "batch_date")
    return read_table(spark, path)


# --- deduplication --------------------------------------------------------

@query
def dedup_batch_exact(spark, sf_dir):
    orders = adapters.raw_orders(spark, sf_dir)
    return latest_by(orders, ["order_id"], "event_timestamp", staging.ORDER_TIES).select(
        "order_id", "status", "total_vnd", "event_timestamp"
    )


@query
def latest_by_key(spark, sf_dir):
    payments = adapters.raw_payments(spark, sf_dir)
    return latest_by(payments, ["payment_id"], "event_timestamp", staging.PAYMENT_TIES)


@query
def replacing_orders(spark, sf_dir):
    orders = adapters.raw_orders(spark, sf_dir, ingested=True)
    return replacing_read(orders, ["city", "placed_at", "order_id"], "_ingested_at").select(
        "city", "placed_at", "order_id", "status", "total_vnd", "_ingested_at"
    )


@query
def replacing_payments(spark, sf_dir):
    payments = adapters.raw_payments(spark, sf_dir, ingested=True)
    tie = ("event_timestamp", *staging.PAYMENT_TIES[2:])
    return replacing_read(payments, ["processed_at", "payment_id"], "_ingested_at", tie=tie).select(
        "processed_at", "payment_id", "amount_vnd", "status", "_ingested_at"
    )


@query
def replacing_riders(spark, sf_dir):
    riders = adapters.raw_rider_events(spark, sf_dir, ingested=True)
    keys = ["city", "event_timestamp", "rider_id"]
    return replacing_read(riders, keys, "_ingested_at", tie=("event_id",)).select(
        *keys, "event_id", "status", "battery_pct"
    )


@query
def final_vs_raw(spark, sf_dir):
    return duplicate_report(adapters.raw_orders(spark, sf_dir), ["order_id"], ["city"])


# --- landing, streams -----------------------------------------------------

TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"
#: Rows of a landed file, and files of a feed at least. A compressed file is one task.
FILE_ROWS, FEED_FILES = 200_000, 16
#: Quantiles of a feed's event times from which the starts of its files are taken.
FEED_PLACES = 10_000
MAX_FILES = 50   # of a trigger, as the job has it
MAX_BYTES = 4 << 30   # of a trigger that is limited by bytes


def land(df: DataFrame, path: str, file_rows: int = FILE_ROWS) -> None:
    """JSON lines as the message bridge leaves them, compressed; ``file_rows`` of 0: any number."""
    (df.write.mode("append").option("timestampFormat", TS_FORMAT).option("compression", "gzip")
     .option("maxRecordsPerFile", file_rows).json(path))


def event_days(df: DataFrame) -> list[dt.date]:
    days = df.select(F.to_date(utc_datetime("event_timestamp")).alias("d")).distinct().orderBy("d").collect()
    return [r.d for r in days]


def _file_starts(df: DataFrame, copies: int) -> list[float]:
    """Event times, in microseconds, at which the files of a feed but the first begin. One pass
    over the times alone gives the number of rows and their quantiles."""
    shares = ",".join(f"{i / FEED_PLACES}D" for i in range(1, FEED_PLACES))
    found = df.select(F.unix_micros("event_timestamp").alias("at")).agg(
        F.count("*").alias("rows"),
        F.expr(f"percentile_approx(at, array({shares}), {FEED_PLACES})").alias("at"),
    ).first()
    files = max(FEED_FILES, copies * found["rows"] // FILE_ROWS)
    if not found["at"]:
        return []
    return sorted({float(found["at"][max(0, i * FEED_PLACES // files - 1)])
                   for i in range(1, files)})


def land_in_order(df: DataFrame, path: str, copies: int = 1) -> int:
    """The feed in order of event time, file by file; each record ``copies`` times. Returns the
    number of files. Written at once; then the files get the times at which they would have
    come, which is the order in which a stream reads them.

    All columns are computed once: a range shuffle would do so a second time, for its sample.
    """
    spark, starts = df.sparkSession, _file_starts(df, copies)
    at = F.unix_micros("event_timestamp").cast("double")
    placed = df.withColumn("__at", F.coalesce(at, F.lit(-math.inf)))   # without a time: first
    if starts:
        placed = Bucketizer(splits=[-math.inf, *starts, math.inf], inputCol="__at",
                            outputCol="__file").transform(placed)
    else:
        placed = placed.withColumn("__file", F.lit(0))
    ordered = placed.repartitionById(len(starts) + 1, F.col("__file").cast("int"))
    # Copied after the shuffle, which so carries each record once, and as a line, made once.
    line = F.to_json(F.struct(*df.columns), {"timestampFormat": TS_FORMAT}).alias("value")
    copied = ordered.select(line).withColumn("__copy", F.explode(F.sequence(F.lit(1), F.lit(copies))))
    with brief_shuffles(spark):
        copied.drop("__copy").write.mode("append").option("compression", "gzip").text(path)
    landed = Folder(spark, path)
    names = landed.names()
    start = dt.datetime.now(dt.timezone.utc) - dt.timedelta(seconds=len(names))
    for i, name in enumerate(names):
        landed.child(name).date(start + dt.timedelta(seconds=i))
    return len(names)


def files_per_batch(spark: SparkSession, path: str, batches: int = BATCHES) -> int:
    """So many files a trigger that a drain of this folder takes about ``batches``."""
    return max(1, -(-Folder(spark, path).size()[1] // (2 * batches)))


def _stream_dedup(spark, raw: DataFrame, topic: str, columns: list[str]) -> DataFrame:
    """Every record arrives twice; the drained lake holds each (id, time) once. The delay and the
    limit of files are those that the job has."""
    base = scratch_dir(spark, f"stream-{topic}")
    files = land_in_order(raw, f"{base}/landing", copies=2)
    drain_topic(spark, topic, f"{base}/landing", f"{base}/lake", f"{base}/checkpoint",
                max_files=min(MAX_FILES, -(-files // BATCHES)))
    return lake.read_lake(spark, f"{base}/lake", TOPICS[topic][0]).select(
        *columns, "event_timestamp", *lake.DAY_COLUMNS
    )


@query
def stream_dedup_orders(spark, sf_dir):
    raw = adapters.raw_orders(spark, sf_dir)
    return _stream_dedup(spark, raw, "orders", ["order_id", "status", "total_vnd"])


@query
def stream_dedup_orders_bytes(spark, sf_dir):
    """The same lake from a drain whose batches are limited by bytes."""
    base = scratch_dir(spark, "stream-bytes")
    raw = adapters.raw_orders(spark, sf_dir)
    land_in_order(raw, f"{base}/landing", copies=2)
    size, _ = Folder(spark, f"{base}/landing").size()
    drain_topic(spark, "orders", f"{base}/landing", f"{base}/lake", f"{base}/checkpoint",
                max_bytes=min(MAX_BYTES, size // BATCHES + 1))
    return lake.read_lake(spark, f"{base}/lake", ORDERS).select(
        "order_id", "status", "total_vnd", "event_timestamp", *lake.DAY_COLUMNS)


@query
def stream_dedup_payments(spark, sf_dir):
    raw = adapters.raw_payments(spark, sf_dir)
    return _stream_dedup(spark, raw, "payments", ["payment_id", "order_id"])


@query
def stream_dedup_riders(spark, sf_dir):
    raw = adapters.raw_rider_events(spark, sf_dir)
    return _stream_dedup(spark, raw, "rider_events", ["event_id", "battery_pct"])


def _late_runs(spark, sf_dir):
    """A second run brings every order again, a week later; most are behind the watermark."""
    base = scratch_dir(spark, "stream-late")
    raw = adapters.raw_orders(spark, sf_dir)
    later = F.col("event_timestamp") + F.expr(f"INTERVAL {SHIFT_DAYS} DAYS")
    batches = []
    for run, rows in enumerate((raw, raw.withColumn("event_timestamp", later))):
        files = land_in_order(rows, f"{base}/landing/{run}")
        # No record comes twice in one run, so slices would hold every key a second time.
        batches += drain_topic(spark, "orders", f"{base}/landing", f"{base}/lake",
                               f"{base}/checkpoint", max_files=-(-files // BATCHES),
                               delay=FEED_DELAY, spread=0)
    return base, batches


@query
def stream_late_drop(spark, sf_dir):
    base, _ = _late_runs(spark, sf_dir)
    return lake.read_lake(spark, f"{base}/lake", ORDERS).select(
        "order_id", "event_timestamp", "total_vnd"
    )


@query
def stream_progress(spark, sf_dir):
    _, batches = _late_runs(spark, sf_dir)
    return batch_rows(spark, "stream-orders", batches).agg(
        F.sum("input_rows").alias("input_rows"), F.sum("late_rows").alias("late_rows"),
        F.sum("stored_rows").alias("stored_rows"),
        (F.countDistinct("batch_id") >= 2 * 5).alias("many_batches"),
    )


def _broken(raw: DataFrame) -> DataFrame:
    """Lines: cancelled orders lose their city, confirmed ones get an unreadable amount."""
    broken = raw.withColumns({
        "city": F.when(F.col("status") != "cancelled", F.col("city")),
        "total_vnd": F.when(F.col("status") == "CONFIRMED", "n/a").otherwise(
            F.col("total_vnd").cast("string")),
    })
    text = F.to_json(F.struct(*broken.columns), {"timestampFormat": TS_FORMAT})
    numbers = F.regexp_replace(text, r'"total_vnd":"(\d+)"', r'"total_vnd":$1')
    return broken.select("event_timestamp", numbers.alias("value"))


#: Rows of a file of the accounted feed; a batch takes as many files as its rows fill.
ACCOUNTING_FILE_ROWS = 100_000


def _land_turns(lines: DataFrame, turns: list[dt.date], files: int, path: str) -> None:
    """Lines (value, day) as the feed that brings these days one after the other, a repeated one
    again, in ``files`` files each. Every line is built and shuffled once."""
    spark = lines.sparkSession
    order = spark.createDataFrame(list(zip(turns, range(len(turns)))), "day date, turn int")
    piece = F.pmod(F.xxhash64("value"), F.lit(files)).alias("piece")
    dealt = lines.where(F.col("day").isNotNull()).select("value", "day", piece).repartition(
        max(1, len(set(turns)) * files), "day", "piece")
    with brief_shuffles(spark):
        (dealt.join(F.broadcast(order), "day").select("value", "turn", "piece")
         .write.option("compression", "gzip").partitionBy("turn", "piece").text(path))
    landed = Folder(spark, path)
    start = dt.datetime.now(dt.timezone.utc) - dt.timedelta(seconds=len(turns))
    for place in landed.folders_with_files(2):
        turn = int(place.split("/")[0].split("=")[1])
        for name in landed.child(place).names():
            landed.child(f"{place}/{name}").date(start + dt.timedelta(seconds=turn))


@query
def stream_accounting(spark, sf_dir):
    """A run of over a hundred batches: every landed line is stored, late, a duplicate or bad.

    Each order arrives twice, some are broken, and the first day comes again at the end.
    """
    base = scratch_dir(spark, "stream-accounting")
    raw = adapters.raw_orders(spark, sf_dir)
    lines = _broken(raw).withColumn("day", F.to_date(utc_datetime("event_timestamp")))
    days = event_days(raw)
    each = -(-110 // (2 * len(days))) if days else 1
    per_batch = raw.count() // (len(days) * each) if days else 0
    width = 1 + per_batch // ACCOUNTING_FILE_ROWS
    _land_turns(lines, [d for d in days for _ in range(2)] + days[:1], each * width,
                f"{base}/landing")
    run = ingest_topic(
        spark, "orders", f"{base}/landing", f"{base}/lake", f"{base}/checkpoint",
        f"{base}/quarantine", f"{base}/metrics", max_files=width, quarantine_files=20 * width,
        delay=FEED_DELAY, state_partitions=max(4, 2 * width), spread=0,
    )
    in_lake = lake.read_lake(spark, f"{base}/lake", ORDERS).count()
    in_quarantine = spark.read.parquet(f"{base}/quarantine").count()
    counted = F.col("stored_rows") + F.col("late_rows") + F.col("duplicate_rows")
    return read_runs(spark, f"{base}/metrics").where(F.col("run_id") == run["run_id"]).select(
        "input_rows", "stored_rows", "late_rows", "duplicate_rows", "quarantined_rows",
        F.lit(in_lake).cast("bigint").alias("in_lake"),
        F.lit(in_quarantine).cast("bigint").alias("in_quarantine"),
        (F.col("batches") > 100).alias("over_100_batches"),
        (counted + F.col("quarantined_rows") == F.col("input_rows")).alias("nothing_lost"),
    )


@query
def stream_skipped_batch(spark, sf_dir):
    """A batch whose input vanished, one with all orders, and an empty one."""
    base = scratch_dir(spark, "stream-skip")
    rows = with_event_date_parts(adapters.raw_orders(spark, sf_dir))
    rows.write.parquet(f"{base}/gone")
    gone = spark.read.schema(rows.schema).parquet(f"{base}/gone")
    Folder(spark, f"{base}/gone").delete()
    writer = BatchWriter(f"{base}/lake", on_missing="skip")
    for number, batch in enumerate((gone, rows, rows.limit(0))):
        writer(batch, number)
    batches = [{"batch_id": b["batch_id"], "input_rows": b["rows"], "stored_rows": b["rows"],
                "late_rows": 0, "duplicate_rows": 0} for b in writer.batches]
    run = store_run(spark, f"{base}/metrics", "stream-orders", batches, skips=writer.skips)
    in_lake = lake.read_lake(spark, f"{base}/lake", ORDERS).count()
    return read_runs(spark, f"{base}/metrics").where(F.col("run_id") == run["run_id"]).select(
        "skipped_batches", "stored_rows", F.lit(in_lake).cast("bigint").alias("in_lake"),
        F.col("batches").alias("written_batches"))


class Killed(RuntimeError):
    """What stands for a driver that dies."""


@query
def stream_restart_verified(spark, sf_dir):
    """A drain is killed after its second batch was written and before it was committed. The
    restart makes that batch again; what the state remembers is then what the lake holds."""
    base = scratch_dir(spark, "stream-restart")
    files = land_in_order(adapters.raw_orders(spark, sf_dir), f"{base}/landing", copies=2)
    settings = {"max_files": min(MAX_FILES, -(-files // BATCHES)), "delay": "3650 days",
                "spread": 0, "state_partitions": 4}
    writer = BatchWriter(f"{base}/lake")

    def dying(df, batch_id):
        writer(df, batch_id)
        if batch_id == 1:
            raise Killed

    try:
        drain_topic(spark, "orders", f"{base}/landing", f"{base}/lake", f"{base}/checkpoint",
                    writer=dying, **settings)
        died = False
    except (StreamingQueryException, Killed):
        died = True
    again = state.open_batches(spark, f"{base}/checkpoint")
    drain_topic(spark, "orders", f"{base}/landing", f"{base}/lake", f"{base}/checkpoint",
                **settings)
    stored = lake.read_lake(spark, f"{base}/lake", ORDERS).select("order_id", "event_timestamp")
    known = state.state_keys(spark, f"{base}/checkpoint").select("order_id", "event_timestamp")
    names = [r.operator for r in state.state_operators(spark, f"{base}/checkpoint").collect()]
    both = stored.join(known, ["order_id", "event_timestamp"], "full").agg(F.count("*")).first()[0]
    return spark.createDataFrame(
        [(died, again == [1], stored.count(), known.count(), both,
          not state.open_batches(spark, f"{base}/checkpoint"), names == ["dedupe"])],
        "died boolean, one_batch_again boolean, stored_rows bigint, state_keys bigint, "
        "rows_in_either bigint, all_committed boolean, one_operator boolean")


def _landed_orders(spark, sf_dir, name):
    base = scratch_dir(spark, name)
    files = land_in_order(adapters.raw_orders(spark, sf_dir), f"{base}/landing")
    stream = landing.read_events(spark, f"{base}/landing", ORDERS, -(-files // BATCHES))
    return base, landing.split_corrupt(stream, ["order_id", "placed_at"])[0]


@query
def stream_hourly_city(spark, sf_dir):
    base, orders = _landed_orders(spark, sf_dir, "stream-hourly")
    hourly.drain_hourly_totals(orders, f"{base}/sums", f"{base}/checkpoint")
    return hourly.read_hourly_totals(spark, f"{base}/sums")


@query
def stream_hourly_partials(spark, sf_dir):
    base, orders = _landed_orders(spark, sf_dir, "stream-partials")
    hourly.drain_hourly_partials(orders, f"{base}/sums", f"{base}/checkpoint")
    return hourly.read_hourly_partials(spark, f"{base}/sums")


@query
def stream_hourly_levels(spark, sf_dir):
    """Sums of every batch, merged two by two; reading opens few folders."""
    base, orders = _landed_orders(spark, sf_dir, "stream-levels")
    hourly.drain_hourly_levels(orders, f"{base}/sums", f"{base}/checkpoint", fan=2)
    return hourly.read_hourly_levels(spark, f"{base}/sums")


@query
def hourly_city_batch(spark, sf_dir):
    return hourly.hourly_city_batch(adapters.raw_orders(spark, sf_dir))


def _as_text(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({
        c: F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'") for c in columns
    })


def _typed_stream(spark, queue: DataFrame, name: str, make) -> DataFrame:
    """All-text rows of a queue, typed by a stream in several batches."""
    base = scratch_dir(spark, f"stream-typed-{name}")
    land(queue, f"{base}/queue", max(1, min(FILE_ROWS, -(-queue.count() // BATCHES))))
    stream = spark.readStream.schema(queue.schema).option(
        "maxFilesPerTrigger", files_per_batch(spark, f"{base}/queue")).json(f"{base}/queue")
    # A row is typed where it is read, and stays there: landed files are neither many nor large.
    drain(make(stream), BatchWriter(f"{base}/raw", partition_by=(), files=None),
          f"{base}/checkpoint")
    return spark.read.parquet(f"{base}/raw")


@query
def stream_typed_ingest(spark, sf_dir):
    queue = _as_text(adapters.raw_orders(spark, sf_dir), "placed_at", "event_timestamp")
    return _typed_stream(spark, queue, "orders", typed.typed_orders).select(
        "order_id", "customer_id", "status", "total_vnd", "placed_at", "event_timestamp"
    )


@query
def stream_typed_payments(spark, sf_dir):
    queue = _as_text(adapters.raw_payments(spark, sf_dir), "processed_at", "event_timestamp")
    return _typed_stream(spark, queue, "payments", typed.typed_payments).select(
        "payment_id", "order_id", "amount_vnd", "method", "processed_at", "event_timestamp"
    )


@query
def stream_typed_riders(spark, sf_dir):
    queue = _as_text(adapters.raw_rider_events(spark, sf_dir), "event_timestamp").withColumn(
        "order_id", F.coalesce("order_id", F.lit(""))
    )
    return _typed_stream(spark, queue, "riders", typed.typed_rider_events).select(
        "event_id", "rider_id", "order_id", "speed_kmh", "battery_pct", "event_timestamp"
    )


@query
def typed_payment_ingest(spark, sf_dir):
    queue = _as_text(adapters.raw_payments(spark, sf_dir), "processed_at", "event_timestamp")
    return typed.typed_payments(queue).select(
        "payment_id", "order_id", "amount_vnd", "method", "processed_at", "event_timestamp"
    )


@query
def typed_rider_ingest(spark, sf_dir):
    queue = _as_text(adapters.raw_rider_events(spark, sf_dir), "event_timestamp").withColumn(
        "order_id", F.coalesce("order_id", F.lit(""))
    )
    return typed.typed_rider_events(queue).select(
        "event_id", "rider_id", "order_id", "speed_kmh", "battery_pct", "event_timestamp"
    )


@query
def stream_quarantine(spark, sf_dir):
    base = scratch_dir(spark, "stream-quarantine")
    (_broken(adapters.raw_orders(spark, sf_dir)).select("value")
     .write.option("compression", "gzip").option("maxRecordsPerFile", FILE_ROWS)
     .text(f"{base}/landing"))
    drain_quarantine(spark, "orders", f"{base}/landing", f"{base}/bad", f"{base}/checkpoint",
                     max_files=files_per_batch(spark, f"{base}/landing"))
    return spark.read.parquet(f"{base}/bad").groupBy("reason").agg(
        F.count("*").alias("records"), F.count("record").alias("kept_lines")
    )


# --- loads, storage -------------------------------------------------------

def _load_twice(spark, sf_dir, mode):
    base = scratch_dir(spark, "load")
    land(adapters.raw_orders(spark, sf_dir), landing.landing_day(base, "orders", LOAD_DATE))
    for _ in range(2):
        landing.load_day(spark, f"{base}/orders", f"{base}/raw_orders", ORDERS, LOAD_DATE, mode)
    return landing.read_raw(spark, f"{base}/raw_orders", ORDERS).select(
        "order_id", "status", "total_vnd", "event_timestamp"
    )


@query
def load_day_append(spark, sf_dir):
    return _load_twice(spark, sf_dir, "append")


@query
def load_day_replace(spark, sf_dir):
    return _load_twice(spark, sf_dir, "replace_day")


@query
def load_day_missing(spark, sf_dir):
    """A landed day reports its rows, a day without files reports none."""
    base = scratch_dir(spark, "load")
    land(adapters.raw_payments(spark, sf_dir), landing.landing_day(base, "payments", LOAD_DATE))
    loaded = [
        (day.isoformat(), landing.load_day(spark, f"{base}/payments", f"{base}/raw_payments",
                                           PAYMENTS, day))
        for day in (LOAD_DATE, LOAD_DATE + dt.timedelta(days=1))
    ]
    return spark.createDataFrame(loaded, "load_date string, rows_loaded bigint")


#: Days that the lake of the given orders has, about.
LAKE_DAYS = 14


def _write_lake(spark, sf_dir, files: int) -> str:
    """A lake whose days have about ``files`` files, or more where a file would have over
    ``FILE_ROWS`` rows; no task writes more than a few times that."""
    base = scratch_dir(spark, "lake")
    rows = with_event_date_parts(adapters.raw_orders(spark, sf_dir)).withColumn(
        lake.BATCH_COLUMN, F.lit(0).cast("bigint")
    )
    tasks = rows.count() // FILE_ROWS
    slices = max(files, -(-tasks // LAKE_DAYS))
    slice_of = F.pmod(F.xxhash64("order_id", "event_timestamp"), F.lit(slices))
    with brief_shuffles(spark):
        (rows.repartition(max(LAKE_DAYS * files, tasks), *lake.DAY_COLUMNS, slice_of)
         .write.partitionBy(*lake.DAY_COLUMNS, lake.BATCH_COLUMN).parquet(base))
    return base


@query
def compact_partition(spark, sf_dir):
    base = _write_lake(spark, sf_dir, files=12)
    compact(spark, base, "2024-01-05")
    return lake.read_lake(spark, base, ORDERS).select(
        "order_id", "event_timestamp", "status", "total_vnd", *lake.DAY_COLUMNS
    )


@query
def compact_outcomes(spark, sf_dir):
    """A day is compacted once; a second run and a day without data are skipped."""
    base = _write_lake(spark, sf_dir, files=12)
    days = (("first", "2024-01-05"), ("again", "2024-01-05"), ("absent", "2024-03-01"))
    done = [(step, compact(spark, base, day)) for step, day in days]
    return spark.createDataFrame(
        [(step, c.rows, c.skipped or "compacted") for step, c in done],
        "step string, total_rows bigint, outcome string")


@query
def read_day_pruned(spark, sf_dir):
    base = _write_lake(spark, sf_dir, files=2)
    return lake.read_day(spark, base, "2024-01-05", ORDERS).select(
        "order_id", "event_timestamp", "status"
    )


@query
def table_stats(spark, sf_dir):
    base = _write_lake(spark, sf_dir, files=2)
    return tables.table_stats(spark, base, lake.DAY_COLUMNS).select(
        *lake.DAY_COLUMNS, "total_rows",
        (F.col("files") >= 1).alias("has_files"), (F.col("bytes") > 0).alias("has_bytes"),
    )


def _fact(spark, sf_dir):
    """The fact as one run of the models made it: stored, so that loads don't make it again."""
    made = model(spark, sf_dir, "fct_orders")
    path = scratch_dir(spark, "fct-made")
    made.write.parquet(path)
    return spark.read.schema(made.schema).parquet(path)


def _upsert(spark, path, rows):
    merge.upsert(spark, path, rows, "order_id", "placed_date", ["city"])


CUT = dt.date(2024, 1, 8)


@query
def fct_upsert(spark, sf_dir):
    """Open orders of the first week are delivered and move to a later day; new days arrive."""
    path = scratch_dir(spark, "fct")
    fct = _fact(spark, sf_dir)
    _upsert(spark, path, fct.where(F.col("placed_date") < F.lit(CUT)))
    open_early = (F.col("placed_date") < F.lit(CUT)) & (F.col("order_status") == "confirmed")
    changes = fct.where((F.col("placed_date") >= F.lit(CUT)) | open_early).withColumns({
        "order_status": F.when(open_early, "delivered").otherwise(F.col("order_status")),
        "is_delivered": F.when(open_early, 1).otherwise(F.col("is_delivered")),
        "placed_date": F.when(open_early, F.date_add("placed_date", 20)).otherwise(
            F.col("placed_date")),
    })
    _upsert(spark, path, changes)
    return merge.read_table(spark, path, fct.schema).select(
        "order_id", "order_status", "is_delivered", "placed_date", "total_vnd"
    )


INCREMENT_CUT = dt.date(2024, 1, 10)


@query
def fct_incremental_lookback(spark, sf_dir):
    """Rows older than the lookback keep their stale status."""
    path = scratch_dir(spark, "fct")
    raw = adapters.raw_tables(spark, sf_dir)
    first = {**raw, "orders": raw["orders"].where(F.col("status") == "PLACED")}
    stale = run_models(spark, first)["fct_orders"]
    _upsert(spark, path, stale.where(F.col("placed_date") < F.lit(INCREMENT_CUT)))
    newest = merge.newest_partition(spark, path, "placed_date")
    full = run_models(spark, raw)["fct_orders"]
    _upsert(spark, path, merge.incremental_source(full, newest, "placed_at_local"))
    return merge.read_table(spark, path, full.schema).select(
        "order_id", "order_status", "placed_date"
    )


@query
def fct_incremental_run(spark, sf_dir):
    """The same outcome from raw tables, shuffling only what the lookback can reach."""
    path = scratch_dir(spark, "fct")
    raw = adapters.raw_tables(spark, sf_dir)
    first = {**raw, "orders": raw["orders"].where(F.col("status") == "PLACED")}
    stale = run_models(spark, first)["fct_orders"]
    _upsert(spark, path, stale.where(F.col("placed_date") < F.lit(INCREMENT_CUT)))
    run_incremental(spark, raw["orders"], raw["payments"], path)
    return merge.read_table(spark, path, stale.schema).select(
        "order_id", "order_status", "placed_date"
    )


@query
def fct_key_ranges(spark, sf_dir):
    """What an upsert knows of every partition before it opens one: rows and range of keys."""
    path = scratch_dir(spark, "fct")
    _upsert(spark, path, model(spark, sf_dir, "fct_orders"))
    live = Ledger(spark, path).latest().of()
    return spark.createDataFrame(
        [(f.part.split("=", 1)[1], f.rows, f.low, f.high) for f in live],
        "placed_date string, total_rows bigint, low_key string, high_key string")


@query
def table_versions(spark, sf_dir):
    """A table over four commits, one of them a repeat of a marked one: rows of each version."""
    table = Ledger(spark, scratch_dir(spark, "versions"))
    orders = adapters.raw_orders(spark, sf_dir).withColumn(
        "day", F.to_date(utc_datetime("placed_at")))
    early, late = (orders.where(side) for side in (
        F.col("day") < F.lit(CUT), F.col("day") >= F.lit(CUT)))
    table.append(early, ("day",), mark=("load", 1))
    table.append(late, ("day",), mark=("load", 2))
    table.append(late, ("day",), mark=("load", 2))
    table.replace_parts(early.where("status = 'PLACED'"), ("day",))
    out = [table.read(snapshot=table.at(v)).groupBy("day").agg(
        F.count("*").alias("total_rows"), F.sum("total_vnd").alias("total_vnd")).select(
        F.lit(v).alias("version"), "*") for v in table.versions()]
    return out[0].unionByName(out[1]).unionByName(out[2])


@query
def fct_schema_evolve(spark, sf_dir):
    path = scratch_dir(spark, "fct")
    fct = _fact(spark, sf_dir)
    _upsert(spark, path, fct)
    wider = fct.where(F.col("placed_date") >= F.lit(CUT)).withColumn("channel", F.col("platform"))
    _upsert(spark, path, wider)
    return merge.read_table(spark, path, wider.schema).select("order_id", "platform", "channel")


# --- analytical queries ---------------------------------------------------

def _orders(spark, sf_dir):
    return adapters.raw_orders(spark, sf_dir)


@query
def q_hourly_revenue_7d(spark, sf_dir):
    return reports.hourly_revenue(_orders(spark, sf_dir), AS_OF, 7)


@query
def q_hourly_volume_7d(spark, sf_dir):
    return reports.hourly_volume(_orders(spark, sf_dir), AS_OF, 7)


@query
def q_method_share_30d(spark, sf_dir):
    return reports.method_share(_orders(spark, sf_dir), AS_OF, 30)


@query
def q_district_30d(spark, sf_dir):
    return reports.district_volume(_orders(spark, sf_dir), AS_OF, 30)


@query
def q_total_count(spark, sf_dir):
    return reports.row_count(_orders(spark, sf_dir))


@query
def q_city_count(spark, sf_dir):
    return reports.by_city(_orders(spark, sf_dir))


@query
def q_join_paid_by_city(spark, sf_dir):
    return reports.paid_by_city(_orders(spark, sf_dir), adapters.raw_payments(spark, sf_dir))


@query
def q_hour_of_day(spark, sf_dir):
    return reports.by_local_hour(_orders(spark, sf_dir))


@query
def q_daily_revenue_utc(spark, sf_dir):
    return reports.daily_revenue_utc(_orders(spark, sf_dir))


@query
def q_city_revenue_m(spark, sf_dir):
    return reports.city_revenue_millions(model(spark, sf_dir, "fct_orders"))


@query
def q_fact_join_report(spark, sf_dir):
    models = run_models(spark, adapters.raw_tables(spark, sf_dir))
    return reports.fact_join_report(models["fct_orders"], models["rpt_hourly_revenue"])


@query
def q_city_hour_pattern(spark, sf_dir):
    return reports.city_hour_pattern(model(spark, sf_dir, "fct_orders"), "hcmc")


@query
def q_report_latest(spark, sf_dir):
    return reports.report_latest(model(spark, sf_dir, "rpt_hourly_revenue"))


# --- dashboards -----------------------------------------------------------

def _rpt(spark, sf_dir):
    return model(spark, sf_dir, "rpt_hourly_revenue")


@query
def d_orders_pivot(spark, sf_dir):
    return dashboards.orders_by_city_pivot(_rpt(spark, sf_dir), *RANGE)


@query
def d_revenue_pivot(spark, sf_dir):
    return dashboards.orders_by_city_pivot(_rpt(spark, sf_dir), *RANGE, "total_revenue_k_vnd")


@query
def d_totals(spark, sf_dir):
    return dashboards.totals(_rpt(spark, sf_dir), *RANGE)


@query
def d_cancel_rate(spark, sf_dir):
    return dashboards.cancellation_rate(_rpt(spark, sf_dir), *RANGE)


@query
def d_avg_order(spark, sf_dir):
    return dashboards.avg_order_value(_rpt(spark, sf_dir), *RANGE)


@query
def d_payment_methods(spark, sf_dir):
    return dashboards.payment_methods(_rpt(spark, sf_dir), *RANGE)


@query
def d_meal_periods(spark, sf_dir):
    return dashboards.meal_periods(_rpt(spark, sf_dir), *RANGE)


@query
def d_freshness(spark, sf_dir):
    return dashboards.freshness(model(spark, sf_dir, "fct_orders"), LOCAL_NOW)


# --- operations -----------------------------------------------------------

@query
def m_latency_percentiles(spark, sf_dir):
    orders = adapters.raw_orders(spark, sf_dir, ingested=True)
    out = reports.ingest_latency(orders, by=["city"], exact=True)
    return out.withColumns({c: F.round(c, 6) for c in ("p50_seconds", "p95_seconds")})


@query
def m_throughput_per_min(spark, sf_dir):
    return reports.throughput_per_minute(_orders(spark, sf_dir), "event_timestamp", ["city"])


@query
def m_readable_counts(spark, sf_dir):
    counted = [
        reports.row_count(df).select(F.lit(name).alias("table_name"), "total")
        for name, df in adapters.raw_tables(spark, sf_dir).items()
    ]
    rows = counted[0].unionByName(counted[1]).unionByName(counted[2])
    return rows.select("table_name", readable_quantity("total").alias("total_rows"))


@query
def m_backlog_alerts(spark, sf_dir):
    samples = adapters.backlog_samples(spark, sf_dir)
    return series.backlog_alerts(samples, tie=["event_id"])


@query
def m_counter_rate(spark, sf_dir):
    return series.counter_rate(
        adapters.metric_samples(spark, sf_dir), ["metric", "instance"], ["metric"],
        window="1 hour", tie=["event_id"],
    )


@query
def m_range_rate(spark, sf_dir):
    """Rates over the last day, every six hours."""
    found = series.range_rate(
        adapters.metric_samples(spark, sf_dir), ["metric", "instance"], ["metric"],
        window="24 hours", step="6 hours", tie=["event_id"])
    return found.withColumn("rate", F.round("rate", 9))


SKETCH_SINCE, SKETCH_UNTIL = dt.datetime(2024, 1, 3, 6), dt.datetime(2024, 1, 9, 18)   # UTC


def _sketched(df):
    at = F.col("placed_at")
    return df.where((at >= F.lit(SKETCH_SINCE).cast("timestamp"))
                    & (at < F.lit(SKETCH_UNTIL).cast("timestamp")))


@query
def m_latency_sketches(spark, sf_dir):
    """Percentiles of a range of hours from stored sketches; whether their ranks are right."""
    orders, probs = adapters.raw_orders(spark, sf_dir, ingested=True), [0.5, 0.95]
    delay = reports.ingest_millis()
    path = scratch_dir(spark, "latency-sketches")
    half = F.pmod(F.xxhash64("order_id"), F.lit(2))
    for load in (0, 1, 1):
        sketches.store(sketches.quantile_sketches(
            orders.where(half == load), "placed_at", delay, ["city"]), path, ("load", load))
    stored = sketches.stored_range(spark, path, SKETCH_SINCE, SKETCH_UNTIL)
    found = sketches.quantiles(stored, probs, ["city"])
    errors = sketches.rank_errors(_sketched(orders), delay, found, probs, ["city"])
    return found.select("city", "low", "high").join(errors, "city").select(
        "city", "samples", "low", "high",
        (F.col("worst") <= 3 * sketches.RANK_ERROR).alias("ranks_are_right"))


@query
def final_vs_raw_sketches(spark, sf_dir):
    """Distinct orders of a range of hours from stored sketches, beside the exact number."""
    orders = adapters.raw_orders(spark, sf_dir)
    path = scratch_dir(spark, "distinct-sketches")
    sketches.store(sketches.distinct_sketches(orders, "placed_at", "order_id", ["city"]), path)
    stored = sketches.stored_range(spark, path, SKETCH_SINCE, SKETCH_UNTIL)
    found = sketches.distinct_counts(stored, ["city"])
    errors = sketches.distinct_errors(_sketched(orders), "order_id", found, ["city"])
    return errors.select("city", "raw_rows", "final_rows",
                         (F.col("off") <= 4 * sketches.COUNT_ERROR).alias("estimate_is_near"))


@query
def m_gauge_rollup(spark, sf_dir):
    return series.gauge_rollup(adapters.metric_samples(spark, sf_dir), ["metric"], "1 hour")


@query
def m_lag_by_group(spark, sf_dir):
    return series.latest_sum(
        adapters.metric_samples(spark, sf_dir), ["metric", "instance"], ["metric"], "1 day",
        tie=["event_id"],
    )


@query
def m_used_percent(spark, sf_dir):
    riders = adapters.raw_rider_events(spark, sf_dir)
    idle = F.count_if(F.col("status") == "available")
    used = series.used_percent(idle.cast("double"), F.count("*").cast("double"))
    return riders.groupBy("city").agg(F.round(used, 6).alias("used_pct"))


# --- data checks ----------------------------------------------------------

@query
def dq_unique(spark, sf_dir):
    return quality.unique(adapters.raw_payments(spark, sf_dir), "payment_id")


@query
def dq_not_null(spark, sf_dir):
    return quality.not_null(
        model(spark, sf_dir, "int_order_payments"),
        ["order_id", "payment_id", "processed_at_local", "payment_delay_seconds"],
    )


@query
def dq_accepted_values(spark, sf_dir):
    return quality.accepted_values(
        model(spark, sf_dir, "stg_riders"), "rider_status", RIDER_STATUSES
    )


@query
def dq_accepted_methods(spark, sf_dir):
    known = PAYMENT_METHODS[:3]
    return quality.accepted_values(model(spark, sf_dir, "stg_orders"), "payment_method", known)


@query
def dq_payment_cap(spark, sf_dir):
    return quality.failures(model(spark, sf_dir, "fct_orders"), quality.payment_cap_check(0.5))


@query
def dq_positive_revenue(spark, sf_dir):
    return quality.failures(model(spark, sf_dir, "fct_orders"), quality.positive_revenue_check())


@query
def dq_revenue_floor(spark, sf_dir):
    """The same check with a floor that orders do fall below."""
    check = quality.positive_revenue_check(floor=5_000_000)
    return quality.failures(model(spark, sf_dir, "fct_orders"), check)


@query
def dq_valid_status(spark, sf_dir):
    check = quality.valid_status_check(ORDER_STATUSES[1:])
    return quality.failures(model(spark, sf_dir, "fct_orders"), check)


@query
def dq_incremental(spark, sf_dir):
    """Results kept per partition, after a load of the first week, and after one of the rest, in
    which open orders of the first week come a second time, twenty days later."""
    path, kept = scratch_dir(spark, "fct"), scratch_dir(spark, "checks")
    fct = model(spark, sf_dir, "fct_orders")
    early = F.col("placed_date") < F.lit(CUT)
    again = fct.where(early & (F.col("order_status") == "confirmed")).withColumn(
        "placed_date", F.date_add("placed_date", 20))
    checks = [quality.not_null_check("payment_amount_vnd"), quality.payment_cap_check(0.5),
              quality.positive_revenue_check(floor=5_000_000),
              quality.valid_status_check(ORDER_STATUSES[1:])]
    table = Ledger(spark, path)
    for load in (fct.where(early), fct.where(~early).unionByName(again)):
        table.add(table.stage(load, ("placed_date",), key="order_id"), load.schema,
                  ("placed_date",))
        check_state.check_changes(spark, path, kept, "order_id", checks)
    return check_state.check_report(spark, kept, "order_id")


@query
def dq_report(spark, sf_dir):
    """All checks over one run whose marts are tables. Models and checks read the staged orders
    and payments many times, by order mostly, so these are stored in buckets of it."""
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    models = run_models(spark, adapters.raw_tables(spark, sf_dir), scratch_dir(spark, "marts"),
                        buckets=buckets)
    return quality.run_checks(models, model_checks())
