"""What the operators share: functions over Arrow arrays, and row numbers over written tables."""

from __future__ import annotations

import io
import os
import uuid
import zipfile
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakeline.session import scratch_dir
from lakeline.sources.fs import Folder

_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give executors this package, whatever their search path is, through the shared folder."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as archive:
        for folder, _, names in os.walk(top):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    archive.write(path, os.path.relpath(path, os.path.dirname(top)))
    target = f"{scratch_dir(spark, 'package')}/lakeline-package.zip"
    Folder(spark, target).write(packed.getvalue())
    context.addPyFile(target)
    _shipped.add(context.applicationId)


def quoted(name: str) -> Column:
    """A column by its exact name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def utf8(name: str) -> Column:
    """A text column as its UTF-8 bytes, which Arrow hands over without decoding."""
    return quoted(name).cast("string").cast("binary")


def text_of(name: str) -> Column:
    return quoted(name).cast("string")


def free_name(df: DataFrame, base: str) -> str:
    """A column name that the DataFrame does not have yet."""
    taken = {c.lower() for c in df.columns}
    return base if base not in taken else f"{base}_{uuid.uuid4().hex}"


#: Bytes of text that a function gets at a time; a longer text is alone.
TEXT_BYTES = 4_000_000


def per_array(returns: str,
              make: Callable[[], Callable[[pa.Array], pa.Array | Iterator[pa.Array]]]):
    """A function of one column; ``make`` runs once per task and gives what maps an array to one
    of the same length, or to several that have its length together.

    Arrow batches of texts are handed over in slices of about ``TEXT_BYTES``, so that a task
    needs memory for a slice, whatever the number of rows in a batch.
    """

    def run(arrays: Iterator[pa.Array]) -> Iterator[pa.Array]:
        apply = make()
        for array in arrays:
            for part in text_slices(array):
                made = apply(array[part])
                yield from [made] if isinstance(made, pa.Array) else made
            pa.default_memory_pool().release_unused()

    return F.arrow_udf(run, returnType=returns)


def text_slices(array: pa.Array) -> Iterator[slice]:
    """Slices of texts by their bytes; an array of anything else is one slice."""
    if not (pa.types.is_string(array.type) or pa.types.is_binary(array.type)):
        return iter([slice(0, len(array))])
    sizes = pc.fill_null(pc.binary_length(array), 0).to_numpy(zero_copy_only=False)
    return slices_of(sizes.tolist(), TEXT_BYTES)


def slices_of(sizes: Sequence[int], limit: int) -> Iterator[slice]:
    """Slices whose sizes add up to ``limit`` at most; what is larger is alone."""
    start = total = 0
    for i, n in enumerate(sizes):
        if i > start and total + n > limit:
            yield slice(start, i)
            start, total = i, 0
        total += n
    if len(sizes) > start:
        yield slice(start, len(sizes))


def batches_of(values: list[bytes | None], limit: int) -> Iterator[slice]:
    """Slices of byte strings by their lengths; null counts as empty."""
    return slices_of([len(v) if v else 0 for v in values], limit)


def stored(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write to the shared scratch folder and read back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Rows that one running count covers before the next block takes over.
BLOCK_ROWS = 50_000


def running_total(table: DataFrame, keep: list[Column], groups: list[Column], weight: Column,
                  out: str, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``keep``, and in ``out`` the sum of ``weight`` over the earlier rows of the same group.

    ``table`` must be a plain read of written Parquet: a row's place is its file and its number
    there, which no rerun changes. Sums run inside blocks of ``block_rows`` rows, and one row
    per block and group carries them on, so a group may hold any share of all rows.
    ``groups`` must not be null.
    """
    group, block, at, add = "__group", "__block", "__at", "__add"
    name = F.col("_metadata.file_name")
    rows = table.select(
        F.struct(*keep).alias("__keep"),
        F.struct(*(g.alias(f"g{i}") for i, g in enumerate(groups)), F.lit(0).alias("one"))
        .alias(group),
        F.struct(
            F.regexp_extract(name, r"part-(\d+)", 1).cast("long").alias("part"),
            F.regexp_extract(name, r"-c(\d+)", 1).cast("long").alias("file"),
            F.floor(F.col("_metadata.row_index") / block_rows).alias("block"),
        ).alias(block),
        F.col("_metadata.row_index").alias(at),
        weight.cast("long").alias(add),
    )
    inside = Window.partitionBy(group, block).orderBy(at).rowsBetween(
        Window.unboundedPreceding, -1)
    across = Window.partitionBy(group).orderBy(block).rowsBetween(
        Window.unboundedPreceding, -1)
    base = rows.groupBy(group, block).agg(F.sum(add).alias("__sum")).select(
        group, block, F.coalesce(F.sum("__sum").over(across), F.lit(0)).alias("__base"))
    local = rows.withColumn("__local", F.coalesce(F.sum(add).over(inside), F.lit(0)))
    return local.join(base, [group, block]).select(
        "__keep.*", (F.col("__base") + F.col("__local")).alias(out))


def list_array(values: np.ndarray | pa.Array, lengths: np.ndarray | list[int]) -> pa.Array:
    """A list column from its flat values and the length of each list."""
    offsets = np.zeros(len(lengths) + 1, np.int32)
    np.cumsum(lengths, out=offsets[1:])
    if not isinstance(values, pa.Array):
        values = pa.array(values)
    return pa.ListArray.from_arrays(pa.array(offsets), values)
