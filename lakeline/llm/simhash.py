"""SimHash fingerprints, and the groups of those that differ in few bits, by pivot tables.

The pivot table of a fingerprint holds its Hamming distances to many reference fingerprints.
By the triangle inequality two fingerprints within k bits have distances to any reference that
differ by k at most. Two kinds of references are used:

- the zero fingerprint and 32 references with two neighbouring bits each. Distance to such a
  reference follows from that to zero and from the number of the fingerprint's bits in the
  block, so two fingerprints within k bits differ in at most k of the 32 coordinates. Cut into
  groups of coordinates, all but k groups agree exactly: that is the key they meet by.
- arbitrary references, which discard most of the pairs that met, by the largest difference.

What is left is verified on the fingerprints themselves.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeline.llm.arrow import per_array, quoted, ship_package, stored, utf8
from lakeline.llm.components import component_labels

BITS, SEED = 64, 42
#: Shingles whose hashes are in memory at a time.
BLOCK_SHINGLES = 100_000
#: Groups of coordinates; a key is all of them but as many as bits may differ.
COORDINATE_GROUPS = 8
#: Arbitrary references, and pairs that are compared at a time.
REFERENCES, BLOCK_PAIRS = 24, 1_000_000
#: Rows of a bucket that one task compares; those of a larger one meet by finer keys.
BUCKET_ROWS = 20_000

_A_TO_Z = bytes(range(65, 91))
_LOWER = bytes.maketrans(_A_TO_Z, _A_TO_Z.lower())


def shingle_hashes(text: bytes, size: int) -> list[int]:
    """XXH64 of every run of ``size`` words, or of all words if there are fewer; none if none."""
    words = text.translate(_LOWER).split()
    if not words:
        return []
    if len(words) <= size:
        return [xxhash.xxh64_intdigest(b" ".join(words), SEED)]
    line = b" ".join(words)
    stops = list(itertools.accumulate(len(w) + 1 for w in words))
    digest = xxhash.xxh64_intdigest
    return [digest(line[a:b - 1], SEED) for a, b in zip([0, *stops], stops[size - 1:])]


def fingerprints(texts: list[bytes | None], size: int) -> np.ndarray:
    """One fingerprint per text: bits that more than half of its shingle hashes have."""
    out = np.zeros(len(texts), np.uint64)
    for i, text in enumerate(texts):
        hashes = np.asarray(shingle_hashes(text, size) if text else [], np.uint64)
        if not len(hashes):
            continue
        ones = np.zeros(BITS, np.int64)
        for at in range(0, len(hashes), BLOCK_SHINGLES):
            part = hashes[at:at + BLOCK_SHINGLES].astype("<u8").view(np.uint8).reshape(-1, 8)
            ones += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
        bits = np.packbits(2 * ones > len(hashes), bitorder="little")
        out[i] = bits.view("<u8")[0]
    return out


def fingerprint(text: str, shingle: int = 3) -> Column:
    """A text column's fingerprint as a 64-bit whole number; null and wordless texts give 0."""

    def make() -> Callable[[pa.Array], pa.Array]:
        def apply(texts: pa.Array) -> pa.Array:
            values = texts.to_pylist()
            return pa.array(fingerprints(values, shingle).view(np.int64), pa.int64())

        return apply

    return per_array("bigint", make)(utf8(text))


#: Bits at even places.
_EVEN = 0x5555555555555555


def block_counts(prints: Column) -> Column:
    """The 32 block coordinates in two bits each.

    With d0 the distance to zero and di that to the reference of block i, (d0 + 2 - di) / 2 is
    the number of bits the fingerprint has in the block: even and odd bits, added in place.
    """
    even = prints.bitwiseAND(F.lit(_EVEN))
    odd = F.shiftrightunsigned(prints, 1).bitwiseAND(F.lit(_EVEN))
    return even.bitwiseXOR(odd).bitwiseOR(F.shiftleft(even.bitwiseAND(odd), 1))


def meeting_masks(distance: int, groups: int = COORDINATE_GROUPS) -> list[int]:
    """Choices of coordinates: whatever ``distance`` groups change, one choice has none of them."""
    if not 0 <= distance < groups or BITS % (2 * groups):
        raise ValueError("groups must divide 32 and be more than the distance")
    width = BITS // groups
    masks = (sum(((1 << width) - 1) << i * width for i in kept)
             for kept in itertools.combinations(range(groups), groups - distance))
    return [m - (1 << BITS) if m >> (BITS - 1) else m for m in masks]


def reference_prints(number: int) -> np.ndarray:
    """Arbitrary, but the same everywhere."""
    return np.asarray([xxhash.xxh64_intdigest(f"reference {i}") for i in range(number)], np.uint64)


class Links:
    """Labels of rows: rows that are linked, directly or not, get the same."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        label = self.label
        while len(a):
            x, y = label[a], label[b]
            apart = x != y
            a, b, x, y = a[apart], b[apart], x[apart], y[apart]
            np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
            while (label != (up := label[label])).any():
                label[:] = up


def bucket_links(key: np.ndarray, prints: np.ndarray, distance: int) -> tuple:
    """Pairs that connect what is linked inside each bucket, fewer than a bucket has rows.

    Rows come sorted by key; the fingerprints of a bucket differ. Each is compared with those
    whose distance to the first reference differs by ``distance`` at most, a range in the order
    of that distance; the other references discard more, then the bits decide. Rows are
    taken in blocks, so memory does not grow with a bucket's pairs.
    """
    references = reference_prints(REFERENCES)
    bucket = np.cumsum(np.append(False, key[1:] != key[:-1]))
    place = bucket * 256 + np.bitwise_count(prints ^ references[0])
    by = np.argsort(place, kind="stable")
    place, prints = place[by], prints[by]
    far = np.bitwise_count(prints[:, None] ^ references[None, 1:]).astype(np.int8)
    stop = np.searchsorted(place, place + distance, "right")
    partners = stop - np.arange(len(prints)) - 1
    done = np.concatenate([[0], np.cumsum(partners)])
    links, at = Links(len(prints)), 0
    while at < len(prints):
        to = max(at + 1, int(np.searchsorted(done, done[at] + BLOCK_PAIRS, "right")) - 1)
        n = partners[at:to]
        a = np.repeat(np.arange(at, to), n)
        b = a + 1 + np.arange(len(a)) - np.repeat(done[at:to] - done[at], n)
        for i in range(far.shape[1]):
            near = np.abs(far[a, i] - far[b, i]) <= distance
            a, b = a[near], b[near]
        near = np.bitwise_count(prints[a] ^ prints[b]) <= distance
        links.add(a[near], b[near])
        at = to
    member = np.flatnonzero(links.label != np.arange(len(prints)))
    return prints[links.label[member]], prints[member]


def bit_masks(distance: int, kept: int = 4) -> list[int]:
    """Choices of ``kept`` of ``distance + kept`` blocks of bits: whatever ``distance`` bits
    change, one choice has none of them."""
    cuts = [BITS * i // (distance + kept) for i in range(distance + kept + 1)]
    blocks = [(1 << stop) - (1 << start) for start, stop in itertools.pairwise(cuts)]
    masks = (sum(some) for some in itertools.combinations(blocks, kept))
    return [m - (1 << BITS) if m >> (BITS - 1) else m for m in masks]


def _compared(keyed: DataFrame, distance: int, limit: int | None) -> DataFrame:
    """(a, b, crowded) of ``keyed`` = (key, print), where the prints of a key differ.

    Links inside the buckets; where a bucket has more than ``limit`` rows, its prints instead, as
    ``a`` of crowded rows. Tasks read buckets in the order of their keys and hold one Arrow batch
    and at most ``limit`` rows before it.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, found, spilled = np.zeros(0, np.int64), np.zeros(0, np.int64), None

        def linked(upto: int) -> pa.RecordBatch:
            k, p = key[:upto], found[:upto]
            first = np.flatnonzero(np.append(True, k[1:] != k[:-1]))
            size = np.diff(np.append(first, upto))
            crowd = (size > limit) | (k[first] == spilled) if limit else np.zeros(len(size), bool)
            shared, crowded = np.repeat((size > 1) & ~crowd, size), p[np.repeat(crowd, size)]
            a, b = bucket_links(k[shared], p[shared].view(np.uint64), distance)
            flag = np.repeat([False, True], [len(a), len(crowded)])
            return pa.RecordBatch.from_arrays([
                pa.array(np.concatenate([a.view(np.int64), crowded]), pa.int64()),
                pa.array(np.concatenate([b.view(np.int64), crowded]), pa.int64()),
                pa.array(flag, pa.bool_())], ["a", "b", "crowded"])

        for batch in batches:
            if not batch.num_rows:
                continue
            key = np.concatenate([key, batch.column(0).to_numpy()])
            found = np.concatenate([found, batch.column(1).to_numpy()])
            # The last bucket may go on in the next batch; a crowded one need not wait for it.
            upto = int(np.searchsorted(key, key[-1], "left"))
            if limit and (len(key) - upto > limit or key[-1] == spilled):
                upto = len(key)
            if upto:
                yield linked(upto)
                spilled = key[-1] if upto == len(key) else spilled
                key, found = key[upto:], found[upto:]
        if len(key):
            yield linked(len(key))

    return (keyed.select("key", "print").repartition("key").sortWithinPartitions("key")
            .mapInArrow(scan, "a bigint, b bigint, crowded boolean"))


def near_links(prints: DataFrame, distance: int) -> DataFrame:
    """(a, b): links among the distinct fingerprints of the only column, enough to connect all
    that are within ``distance`` bits.

    The fingerprints of buckets with more than ``BUCKET_ROWS`` rows, as templated texts have them,
    meet again in buckets that agree in some blocks of their bits too; no such pair is lost, and
    no task compares a crowded bucket.
    """
    column = quoted(prints.columns[0])

    def masks(values: list[int]) -> Column:
        return F.explode(F.array(*(F.lit(m).cast("bigint") for m in values))).alias("mask")

    keyed = prints.select(
        column.alias("print"), block_counts(column).alias("counts"),
        masks(meeting_masks(distance))).select(
        "print", F.xxhash64("mask", F.col("counts").bitwiseAND(F.col("mask"))).alias("key"))
    met = stored(_compared(keyed, distance, BUCKET_ROWS), "links")
    links, crowded = met.where("NOT crowded").select("a", "b"), met.where("crowded")
    if crowded.isEmpty():
        return links
    finer = (crowded.select(F.col("a").alias("print")).distinct()
             .select("print", masks(bit_masks(distance)))
             .select("print", F.xxhash64("mask", F.col("print").bitwiseAND(F.col("mask")))
                     .alias("key")))
    return links.union(_compared(finer, distance, None).select("a", "b"))


def component_of_prints(prints: DataFrame, key: str, print_: str, distance: int) -> DataFrame:
    """(print, component_id): the smallest key that each distinct fingerprint can reach.

    Null keys take no part in the minimum. A group without any other key has a null one.
    """
    distinct = stored(prints.groupBy(quoted(print_).alias("print"))
                      .agg(F.min(quoted(key)).alias("least")), "prints")
    labels = component_labels(near_links(distinct.select("print"), distance))
    labelled = distinct.join(labels.withColumnRenamed("node", "print"), "print", "left").select(
        "print", "least", F.coalesce("label", "print").alias("label"))
    smallest = labelled.groupBy("label").agg(F.min("least").alias("component_id"))
    return labelled.join(smallest, "label").select("print", "component_id")


def near_duplicate_groups(docs: DataFrame, *, key: str = "doc_id", text: str = "text",
                          shingle: int = 3, distance: int = 2) -> DataFrame:
    """Per row: key, fingerprint (16 hex digits) and component_id.

    Texts without words have fingerprint zero and are linked like any other. Repeated rows
    and null keys come back as often as they came; see ``component_of_prints`` for null keys.
    Other columns are not read.
    """
    ship_package(docs.sparkSession)
    prints = stored(docs.select(quoted(key).alias("doc_id"),
                                fingerprint(text, shingle).alias("print")), "fingerprints")
    groups = component_of_prints(prints, "doc_id", "print", distance)
    return prints.join(groups, "print").select(
        "doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each_group(docs: DataFrame, *, key: str = "doc_id", text: str = "text",
                      shingle: int = 3, distance: int = 2) -> DataFrame:
    """The rows of ``docs`` without near duplicates: each group keeps its row with the smallest
    key (null keys last), of equal ones the first in the files. All columns stay.

    Rows are known by file and row number; a DataFrame that is not a plain read, or that has a
    column of the name Spark gives to these, is written first.
    """
    ship_package(docs.sparkSession)
    row = F.struct("_metadata.file_path", "_metadata.row_index")
    columns = docs.columns
    rows, text, key = docs.toDF(*(f"c{i}" for i in range(len(columns)))), *(
        f"c{columns.index(name)}" for name in (text, key))
    try:
        rows.select(row)
    except AnalysisException:
        rows = stored(rows, "documents")
    prints = stored(rows.select(quoted(key).alias("doc_id"), row.alias("row"),
                                fingerprint(text, shingle).alias("print")), "fingerprints")
    groups = component_of_prints(
        prints.select(F.struct(F.col("doc_id").isNull(), "doc_id", "row").alias("first"), "print"),
        "first", "print", distance)
    first = groups.select("component_id.row").distinct()
    return (rows.withColumn("row", row).join(first, "row", "left_semi")
            .select(*rows.columns).toDF(*columns))
