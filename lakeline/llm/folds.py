"""Which rows a model may learn from, and bounded samples of labelled texts."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeline.llm.arrow import quoted, stored

#: A text over this part of the bytes that a sample may have waits until others have been taken.
LONG = 20


def held_out(key: str, parts: int, part: int) -> Column:
    """Whether crc32 of the key as text leaves ``part`` when divided by ``parts``. Rows without
    a key are held out as well: nothing is learned from them."""
    rest = F.crc32(quoted(key).cast("string").cast("binary")) % parts
    return F.coalesce(rest == part, F.lit(True))


def labelled_sample(docs: DataFrame, labels: DataFrame, *, key: str, text: str, label: str,
                    allowed: Column, rows: dict[int, int],
                    max_bytes: dict[int, int]) -> tuple[list[tuple[bytes, int]], dict[int, int]]:
    """Up to ``rows`` texts of the labels 0 and 1, chosen by a hash of the key, on the driver;
    and how many rows have each label.

    Chosen in that order by their lengths, label by label. A text that doesn't fit into what is
    left of ``max_bytes`` is passed over, and very long ones come last, so none takes the place
    of all others; only if no text of a label fits, the shortest is taken. All texts are read
    twice, for the lengths of both labels' candidates and for those that are chosen. A repeated
    row of labels counts once, a repeated document as often as it is there; without labels the
    sample is empty. ``allowed`` is a condition on the labels table.
    """
    order = F.xxhash64(quoted(key), F.lit(label))
    known = labels.where(allowed & quoted(key).isNotNull() & quoted(label).isin(0, 1)).select(
        quoted(key).alias("k"), quoted(label).cast("int").alias("label"), order.alias("order"))
    sizes = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    if not sizes:
        return [], sizes
    texts = docs.where(quoted(text).isNotNull()).select(
        quoted(key).alias("k"), quoted(text).cast("string").cast("binary").alias("t"))
    # A little more than wanted of each label, so that what is broadcast and sorted is bounded.
    share = {v: math.ceil(min(1.0, 1.5 * rows[v] / n) * (1 << 20)) for v, n in sizes.items()}
    dice, wide = F.pmod("order", F.lit(1 << 20)), F.lit(False)
    for value, upto in share.items():
        wide = wide | ((F.col("label") == value) & (dice < upto))
    met = stored(texts.join(F.broadcast(known.where(wide).distinct()), "k").select(
        "k", "label", "order", F.xxhash64("t").alias("hash"), F.length("t").alias("n")),
        "labelled")
    taken: list[tuple[int, int]] = []
    reads: list[tuple] = []
    for value in sorted(sizes):
        of = (met.where(F.col("label") == value).orderBy("order", "k", "hash")
              .limit(2 * rows[value]).select("k", "hash", "n").collect())
        chosen = _fitting([r["n"] for r in of], rows[value], max_bytes[value])
        # Rows of one text are next to each other: they are read once.
        last = None
        for i in chosen:
            if of[i] != last:
                last = of[i]
                reads.append((last["k"], last["hash"], len(reads)))
            taken.append((len(reads) - 1, value))
    wanted = docs.sparkSession.createDataFrame(reads, T.StructType([
        met.schema["k"], T.StructField("h", T.LongType()), T.StructField("at", T.IntegerType())]))
    read = (texts.join(F.broadcast(wanted), "k").where(F.xxhash64("t") == F.col("h"))
            .groupBy("at").agg(F.first("t").alias("t")))
    held = {r["at"]: bytes(r["t"]) for r in read.toLocalIterator()}
    return [(held[at], value) for at, value in taken], sizes


def _fitting(lengths: list[int], rows: int, max_bytes: int) -> list[int]:
    """Places of the texts to take: of the first ``rows`` all that fit, then later ones."""
    chosen, size = [], 0
    for i in sorted(range(len(lengths)),
                    key=lambda i: (i >= rows, lengths[i] * LONG > max_bytes)):
        if len(chosen) < rows and size + lengths[i] <= max_bytes:
            chosen.append(i)
            size += lengths[i]
    if lengths and not chosen:
        chosen.append(min(range(len(lengths)), key=lengths.__getitem__))
    return sorted(chosen)
