"""Day-partitioned lake: pruned reads and idempotent day sinks."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from .fs import Folder, as_date
from .ledger import Ledger

DAY_COLUMNS = ("year", "month", "day")
BATCH_COLUMN = "batch_id"


def lake_schema(schema: T.StructType) -> T.StructType:
    parts = [T.StructField(c, T.IntegerType()) for c in DAY_COLUMNS]
    return T.StructType([*schema, *parts, T.StructField(BATCH_COLUMN, T.LongType())])


def read_lake(spark: SparkSession, base: str, schema: T.StructType) -> DataFrame:
    """The whole lake table; empty with its schema while nothing is written yet."""
    columns = lake_schema(schema)
    if not Folder(spark, base).exists():
        return spark.createDataFrame([], columns).drop(BATCH_COLUMN)
    return spark.read.schema(columns).parquet(base).drop(BATCH_COLUMN)


def read_day(
    spark: SparkSession, base: str, date: str | dt.date, schema: T.StructType
) -> DataFrame:
    """One UTC day, read from its own folder: no other day is listed. An absent day is empty."""
    d, columns = as_date(date), lake_schema(schema)
    day = f"{base.rstrip('/')}/year={d.year}/month={d.month}/day={d.day}"
    if not Folder(spark, day).exists():
        return spark.createDataFrame([], columns).drop(BATCH_COLUMN)
    return spark.read.schema(columns).option("basePath", base).parquet(day).drop(BATCH_COLUMN)


def overwrite_partition(df: DataFrame, base: str, column: str, value: str | dt.date) -> str:
    """Replace exactly one partition, also when the new result is empty; returns its name.

    One commit of a versioned table: readers see the old day or the new one.
    """
    table, part = Ledger(df.sparkSession, base), f"{column}={value}"
    staged = table.stage(df.drop(column), part=part)
    typed = df if column in df.columns else df.withColumn(column, F.lit(_dated(value)))
    table.add(staged, typed.schema, (column,), [part])
    return part


def _dated(value: str | dt.date) -> str | dt.date:
    """A date if the text is one."""
    try:
        return as_date(value)
    except ValueError:
        return value


def overwrite_partitions(df: DataFrame, base: str, column: str) -> None:
    """Replace every partition the result has rows for, in one commit, and leave the others
    alone. A day that a rerun has no rows for is one of these: use ``overwrite_partition``."""
    Ledger(df.sparkSession, base).replace_parts(df, (column,))
