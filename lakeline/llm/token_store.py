"""Token ids in Parquet: one list per document, ordered by document, read back selectively."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeline.llm.arrow import list_array, per_array, quoted, running_total, ship_package, text_of
from lakeline.llm.tokens import broadcast_tokenizer, encoder, with_end

#: How the files are written. Ids repeat, so a dictionary packs them to as many bits as the
#: chunk's vocabulary needs; counts and document ids, which don't, are delta-encoded by the
#: second page format. Row groups and pages are small enough that a reader which wants a few
#: documents, found by the page index, reads little else.
LAYOUT = {
    "compression": "zstd",
    "parquet.writer.version": "PARQUET_2_0",
    "parquet.enable.dictionary": "true",
    "parquet.enable.dictionary#doc_id": "false",
    "parquet.enable.dictionary#n_tokens": "false",
    "parquet.block.size": str(32 << 20),
    "parquet.page.size": str(256 << 10),
    "parquet.page.row.count.limit": "2000",
    "parquet.columnindex.truncate.length": "64",
}


def write_tokens(docs: DataFrame, path: str, *, key: str = "doc_id", text: str = "text",
                 end_id: int | None = 1, tokenizer: str | None = None) -> None:
    """Write (doc_id, n_tokens, ids) in ascending key order, null keys first.

    Null and empty texts hold only the end id, if there is one. Equal keys stay together, in an
    order that a later reader cannot tell. Other columns are not read. Texts are dealt out by
    ranges of the key before they are encoded, because they are smaller than their ids.
    """
    spark = docs.sparkSession
    ship_package(spark)
    described = broadcast_tokenizer(spark, tokenizer)

    def make():
        model = encoder(described)

        def ids(texts: pa.Array) -> pa.Array:
            flat, counts = model.encode(texts)
            flat, counts = with_end(flat, counts, end_id)
            return list_array(flat.view(np.int32), counts)

        return ids

    (docs.select(quoted(key).alias("doc_id"), text_of(text).alias("text"))
     .repartitionByRange("doc_id").sortWithinPartitions("doc_id")
     .select("doc_id", per_array("array<int>", make)("text").alias("ids"))
     .select("doc_id", F.size("ids").alias("n_tokens"), "ids")
     .write.options(**LAYOUT).parquet(path))


def read_tokens(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """The stored lists, or only the named columns; a filter on doc_id reaches the page index."""
    table = spark.read.parquet(path)
    return table.select(*columns) if columns else table


def ids_crc(ids_column: str = "ids"):
    """Checksum of a list of ids as little-endian unsigned 32-bit integers."""

    def make():
        def crc(lists: pa.Array) -> pa.Array:
            flat = np.ascontiguousarray(lists.values.to_numpy(zero_copy_only=False), "<i4")
            bounds = (np.asarray(lists.offsets) * 4).tolist()
            view = memoryview(flat).cast("B") if len(flat) else memoryview(b"")
            return pa.array([zlib.crc32(view[a:b]) for a, b in zip(bounds, bounds[1:])],
                            pa.int64())

        return crc

    return per_array("bigint", make)(quoted(ids_column))


def token_positions(spark: SparkSession, path: str) -> DataFrame:
    """Per stored document: doc_id, n_tokens and ids_crc32 of the list as read, and start, the
    number of ids before it in the whole store. The lists are read once and not shuffled."""
    ship_package(spark)
    return running_total(
        read_tokens(spark, path),
        [F.col("doc_id"), F.size("ids").cast("long").alias("n_tokens"),
         ids_crc().alias("ids_crc32")],
        [], F.col("n_tokens"), "start")
