"""Rendezvous hashing: every record goes to the shard that draws the best score for its key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeline.llm.arrow import free_name, quoted, running_total, stored

#: Hex digits of the digest that make the draw: 2^52 values, exact in a double.
DRAW_DIGITS = 13


def draw(key: Column, shard: int) -> Column:
    """A number above 0 and below 1 that only the key and the shard decide."""
    digest = F.md5(F.concat(F.coalesce(key.cast("string"), F.lit("null")),
                            F.lit(f":{shard}")).cast("binary"))
    value = F.conv(F.substring(digest, 1, DRAW_DIGITS), 16, 10).cast("bigint")
    return (value + 0.5) / float(16 ** DRAW_DIGITS)


def best_shard(key: Column, weights: Sequence[float]) -> Column:
    """The shard with the smallest ``-ln(draw) / weight``; the lower number wins a tie.

    A shard of weight w gets w / sum(weights) of the keys. A shard that is added draws for
    every key, so a key moves only if the new shard wins it; one that is removed gives away
    its own keys only. Weights must be above 0.
    """
    if not weights or any(w <= 0 for w in weights):
        raise ValueError("weights must be above 0")
    scores = [F.struct((-F.log(draw(key, i)) / float(w)).alias("score"), F.lit(i).alias("shard"))
              for i, w in enumerate(weights)]
    return (F.least(*scores) if len(scores) > 1 else scores[0])["shard"]


def assign_shards(df: DataFrame, *, key: str, weights: Sequence[float],
                  out: str = "shard") -> DataFrame:
    """All rows and columns of ``df``, and the shard of each row.

    Equal keys share a shard, null keys too. An existing column named ``out`` is replaced.
    """
    return df.withColumn(out, best_shard(quoted(key), weights))


def shard_listing(docs: DataFrame, *, key: str = "doc_id", text: str = "text",
                  weights: Sequence[float], grown: Sequence[float]) -> DataFrame:
    """Per row: key, size, text_crc32, shard, its slot in the shard and grown_shard.

    ``grown`` are the weights after the shard count changes. Size is the UTF-8 bytes of the
    text plus 1, checksum of a null text that of an empty one. Slots count from 0 in key order
    (null keys first, then by checksum and size), one sequence per shard.
    """
    bytes_of = F.coalesce(quoted(text).cast("string").cast("binary"), F.lit(b""))
    rows = docs.select(
        quoted(key).alias("doc_id"),
        (F.length(bytes_of) + 1).cast("bigint").alias("size"),
        F.crc32(bytes_of).alias("text_crc32"),
        best_shard(quoted(key), weights).alias("shard"),
        best_shard(quoted(key), grown).alias("grown_shard"))
    order = ["doc_id", "text_crc32", "size"]
    listed = stored(rows.repartitionByRange(*order).sortWithinPartitions(*order), "shards")
    return running_total(listed, [quoted(c) for c in listed.columns], [F.col("shard")],
                         F.lit(1), "slot")


def write_shards(df: DataFrame, path: str, *, key: str, weights: Sequence[float]) -> None:
    """Write ``df`` with one folder per shard. Rows are not shuffled: every task appends its
    own file to each folder, so a large shard is never one task's work."""
    shard = free_name(df, "shard")
    assign_shards(df, key=key, weights=weights, out=shard).write.partitionBy(shard).parquet(path)
