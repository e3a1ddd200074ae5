"""Table materialisation and volume."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from .ledger import Ledger


def materialize(
    df: DataFrame,
    kind: str,
    path: str | None = None,
    partition_by: Sequence[str] = (),
    cluster_by: Sequence[str] = (),
    name: str | None = None,
) -> DataFrame:
    """``view``: stay lazy (registered when named). ``table``: the next version
    of the table at ``path``, read back."""
    if kind == "view":
        if name:
            df.createOrReplaceTempView(name)
        return df
    if kind != "table":
        raise ValueError(f"unknown kind {kind!r}; an incremental table uses merge.upsert")
    table = Ledger(df.sparkSession, path)
    return table.read(snapshot=table.replace(df, partition_by, cluster_by)).select(*df.columns)


def table_stats(spark: SparkSession, path: str, by: Sequence[str] = ()) -> DataFrame:
    """Rows, files and bytes of a Parquet table, per partition columns ``by``.

    Reads no data column: row counts come from the file footers. Of a versioned table only the
    live folders count.
    """
    table = Ledger(spark, path)
    now = table.latest()
    if now.version:
        scan = table.scan(now.schema, now)
        scan = table.read(snapshot=now).withColumn(
            "_metadata", F.struct(F.lit("").alias("file_path"), F.lit(0).cast("bigint").alias(
                "file_size"))) if scan is None else scan
    else:
        scan = spark.read.parquet(path)
    files = (
        scan
        .select(*by, "_metadata.file_path", "_metadata.file_size")
        .groupBy(*by, "file_path", "file_size")
        .agg(F.count("*").alias("n"))
    )
    return files.groupBy(*by).agg(
        F.sum("n").alias("total_rows"),
        F.count("*").alias("files"),
        F.sum("file_size").alias("bytes"),
    ).orderBy(F.desc("total_rows"), *by)
