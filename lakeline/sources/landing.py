"""JSON-lines landing zone: stream source, quarantine split, daily raw load."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T

from ..schemas import required as required_fields
from .fs import Folder, as_date
from .ledger import Ledger

CORRUPT = "_corrupt_record"
#: Side data of a raw table.
QUARANTINE = "quarantine"


class TooManyBadRecords(ValueError):
    """More unusable records than the job tolerates."""


def with_corrupt_column(schema: T.StructType) -> T.StructType:
    """File sources ignore declared nullability, so all fields are read as nullable."""
    fields = [T.StructField(f.name, f.dataType, True) for f in schema]
    return T.StructType([*fields, T.StructField(CORRUPT, T.StringType(), True)])


def read_events(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    max_files: int = 50,
    watermark: str | None = None,
    event_time: str = "event_timestamp",
    max_bytes: int | None = None,
) -> DataFrame:
    """Stream a landing folder, oldest files first, with a declared schema.

    Unreadable lines arrive with ``_corrupt_record`` set; see ``split_corrupt``. ``max_bytes``
    limits a batch by the bytes of its files instead of their number, so that batches are alike
    whatever the files; a file beyond the limit is a batch of its own.
    """
    limit = (("maxBytesPerTrigger", max_bytes) if max_bytes is not None
             else ("maxFilesPerTrigger", max_files))
    stream = (
        spark.readStream.schema(with_corrupt_column(schema))
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("latestFirst", "false")
        .option(limit[0], str(limit[1]))
        .option("recursiveFileLookup", "true")
        .json(path)
    )
    return stream.withWatermark(event_time, watermark) if watermark else stream


def _unreadable(df: DataFrame):
    return F.col(CORRUPT) if CORRUPT in df.columns else F.lit(None).cast("string")


def is_bad(df: DataFrame, required: Sequence[str]):
    bad = _unreadable(df).isNotNull()
    for name in required:
        bad = bad | F.col(name).isNull()
    return bad


def split_corrupt(df: DataFrame, required: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(good, quarantine). Bad: not JSON, a field of the wrong type, a required field missing.

    The quarantine keeps the raw line where the parser kept it and a rebuilt
    one where the line was valid JSON without a required value. Rows of a
    lenient typed ingest can be split as well: what could not be read is NULL.
    """
    bad, unreadable = is_bad(df, required), _unreadable(df)
    data = [c for c in df.columns if c != CORRUPT]
    missing = F.array_compact(
        F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in required])
    )
    reason = F.when(unreadable.isNotNull(), F.lit("unreadable")).otherwise(
        F.concat(F.lit("missing "), F.array_join(missing, ","))
    )
    record = F.coalesce(unreadable, F.to_json(F.struct(*data)))
    good = df.where(~bad).select(*data)
    return good, df.where(bad).select(reason.alias("reason"), record.alias("record"))


def assert_max_bad(quarantine: DataFrame, limit: int = 10) -> int:
    """Count at most ``limit + 1`` bad records and fail beyond ``limit``."""
    found = quarantine.limit(limit + 1).count()
    if found > limit:
        raise TooManyBadRecords(f"more than {limit} bad records")
    return found


def landing_day(base: str, topic: str, date: str | dt.date) -> str:
    """Landing folders carry the UTC write date, with padded month and day."""
    d = as_date(date)
    return f"{base.rstrip('/')}/{topic}/year={d.year}/month={d.month:02d}/day={d.day:02d}"


def load_day(
    spark: SparkSession,
    topic_dir: str,
    table_path: str,
    schema: T.StructType,
    date: str | dt.date,
    mode: str = "append",
    max_bad: int = 0,
) -> int:
    """Load one landing day into the raw table and return the rows loaded.

    ``append`` repeats the rows on a rerun (staging absorbs them); ``replace_day`` replaces the
    earlier loads of that day. One pass counts and writes. Good rows and the bad records, of
    which up to ``max_bad`` are tolerated (see ``read_quarantine``), become visible by one
    commit, so a load that failed, was rejected or died leaves neither behind.
    """
    d = as_date(date)
    source = landing_day(*topic_dir.rstrip("/").rsplit("/", 1), d)
    if not Folder(spark, source).exists():
        return 0
    lines = (
        spark.read.schema(with_corrupt_column(schema))
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("recursiveFileLookup", "true")
        .json(source)
    )

    needed = required_fields(schema)
    seen = Observation()
    counted = lines.withColumn("__bad", is_bad(lines, needed)).observe(
        seen,
        F.count_if(F.col("__bad")).alias("bad"),
        F.count_if(~F.col("__bad")).alias("good"),
    )
    table, part = Ledger(spark, table_path), f"load_date={d.isoformat()}"
    staged = table.stage(counted.where(~F.col("__bad")).drop("__bad", CORRUPT), part=part)
    counts = seen.get
    if counts["bad"] > max_bad:
        raise TooManyBadRecords(f"{counts['bad']} bad records in {source}")
    if counts["bad"]:
        staged += table.stage(split_corrupt(lines, needed)[1], kind=QUARANTINE, part=part)
    table.add(staged, _raw_schema(schema), ("load_date",),
              [part] if mode == "replace_day" else [], ["data", QUARANTINE])
    return counts["good"]


def _raw_schema(schema: T.StructType) -> T.StructType:
    fields = [T.StructField(f.name, f.dataType, True) for f in schema]
    return T.StructType([*fields, T.StructField("load_date", T.DateType())])


def read_quarantine(spark: SparkSession, table_path: str) -> DataFrame:
    """The bad records of all loads that the raw table holds, with their reason."""
    return Ledger(spark, table_path).read(
        kind=QUARANTINE, schema=T.StructType.fromDDL("reason string, record string, load_date date"))


def read_raw(spark: SparkSession, table_path: str, schema: T.StructType,
             with_load_date: bool = False) -> DataFrame:
    """The raw table over all loads; ``with_load_date`` keeps the partition column."""
    table = Ledger(spark, table_path).read(schema=_raw_schema(schema))
    return table if with_load_date else table.drop("load_date")
