"""Token counts without shuffling pre-tokens: a broadcast table of frequent ones, worker caches."""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeline.llm.arrow import per_array, quoted, ship_package, text_of
from lakeline.llm.tokens import WordEncoder, broadcast_tokenizer, encoder, unit_blocks

#: Entries of the broadcast table: about a megabyte, whatever the corpus holds.
TABLE_WORDS = 32_768
#: Words that a task reports as its most frequent, and that it counts at a time.
TASK_WORDS, TASK_COUNTED = 1024, 200_000


def frequent_units(docs: DataFrame, text: str, size: int) -> list[str]:
    """The units (words without the marks after them) that stand out over all documents, most
    frequent first.

    Every task reads all its texts, keeps counts of a bounded number of units (the rarer half
    goes when there are too many) and reports its best ``TASK_WORDS``; only these reports are
    added up. The choice steers what is fast, never a count of tokens.
    """

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[str] = Counter()
        for batch in batches:
            for block in unit_blocks(batch.column(0)):
                times = np.bincount(block.which, minlength=len(block.units))
                # A block's units that come once would only crowd out others.
                often = np.flatnonzero(times > 1)
                seen.update({block.units[i]: n
                             for i, n in zip(often.tolist(), times[often].tolist())})
                if len(seen) > TASK_COUNTED:
                    seen = Counter(dict(seen.most_common(TASK_COUNTED // 2)))
        top = seen.most_common(TASK_WORDS)
        yield pa.RecordBatch.from_arrays(
            [pa.array([w for w, _ in top], pa.string()), pa.array([n for _, n in top], pa.int64())],
            ["word", "n"])

    reports = docs.select(text_of(text).alias("text")).mapInArrow(best, "word string, n bigint")
    rows = (reports.groupBy("word").agg(F.sum("n").alias("n"))
            .orderBy(F.desc("n"), "word").limit(size).collect())
    return [r["word"] for r in rows]


class LengthTable:
    """Units and their numbers of tokens, packed for the broadcast."""

    def __init__(self, units: list[str], lengths: list[int]):
        self.blob = "\n".join(units)
        self.lengths = np.asarray(lengths, np.int32)

    def unpacked(self) -> dict[str, int]:
        return dict(zip(self.blob.split("\n"), self.lengths.tolist()))


class Tiers:
    """Lengths of texts from the two tiers; what neither holds is encoded."""

    def __init__(self, model: WordEncoder, frequent: dict[str, int]):
        self.model, self.frequent = model, frequent
        self.cache: dict[str, int] = {}

    def of_units(self, units: list[str]) -> np.ndarray:
        lengths = list(map(self.frequent.get, units))
        rare = [i for i, n in enumerate(lengths) if n is None]
        for i in rare:
            lengths[i] = self.cache.get(units[i])
        fresh = [i for i in rare if lengths[i] is None]
        for i, ids in zip(fresh, self.model.encode_units([units[i] for i in fresh])):
            lengths[i] = len(ids) // 4
        for i in fresh[:max(0, self.model.cache_words - len(self.cache))]:
            self.cache[units[i]] = lengths[i]
        return np.asarray(lengths, np.int64)

    def lengths(self, texts: pa.Array) -> np.ndarray:
        out = [np.zeros(0, np.int64)]
        for block in unit_blocks(texts):
            total = np.cumsum(self.of_units(block.units)[block.which])
            out.append(np.diff(np.append(0, total)[block.ends], prepend=0))
        return np.concatenate(out)


#: The worker's tiers for the last broadcast table, kept from task to task.
_tiers: dict[str, Tiers] = {}


def count_tokens(docs: DataFrame, *, key: str = "doc_id", text: str = "text",
                 limit: int = 2048, tokenizer: str | None = None,
                 table_words: int = TABLE_WORDS) -> DataFrame:
    """Per row: key, n_bytes, n_tokens and whether n_tokens is over ``limit``.

    Null and empty texts have 0 bytes and 0 tokens. Repeated rows and null keys come back as
    often as they came. Other columns are not read.
    """
    spark = docs.sparkSession
    ship_package(spark)
    described = broadcast_tokenizer(spark, tokenizer)
    words = frequent_units(docs, text, table_words)
    ids = WordEncoder(described.value).encode_units(words)
    table = spark.sparkContext.broadcast(LengthTable(words, [len(one) // 4 for one in ids]))
    name = uuid.uuid4().hex

    def make():
        if name not in _tiers:
            _tiers.clear()
            _tiers[name] = Tiers(encoder(described), table.value.unpacked())
        tiers = _tiers[name]
        return lambda texts: pa.array(tiers.lengths(texts), pa.int64())

    n_tokens = per_array("bigint", make)(text_of(text))
    return (docs.select(quoted(key).alias(key),
                        F.coalesce(F.octet_length(quoted(text).cast("string")), F.lit(0))
                        .cast("long").alias("n_bytes"),
                        n_tokens.alias("n_tokens"))
            .withColumn("over_limit", F.col("n_tokens") > limit))
