"""Packing of token pieces into sequences: large pieces are matched in pairs, small ones fill.

A piece over a third of the capacity shares a sequence with at most one other such piece, so
packing them is a matching: the largest takes the largest partner that fits. All others go,
longest first, where they leave the smallest gap. Lengths are whole numbers up to the capacity,
so the packing is planned on the number of pieces of each length, a table of at most
``capacity`` rows, and each piece then finds its place by its number among those of its length.
"""

from __future__ import annotations

import bisect
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeline.llm.arrow import list_array, per_array, quoted, running_total, ship_package, stored, text_of
from lakeline.llm.tokens import broadcast_tokenizer, encoder, with_end


class Plan:
    """Runs of equal placements: pieces ``first`` to ``first + count - 1`` of a length go to
    sequences from ``sequence`` on, ``per`` to each, the first at ``offset``."""

    def __init__(self, counts: dict[int, int], capacity: int):
        self.capacity = capacity
        self.runs: list[tuple[int, int, int, int, int]] = []
        self.used = dict.fromkeys(counts, 0)
        self.sequences = 0
        # Open sequences by the gap they have left: spans of (first sequence, how many).
        self.open: dict[int, list[tuple[int, int]]] = {}
        self.gaps: list[int] = []
        self._match({n: c for n, c in counts.items() if 3 * n > capacity})
        for length in sorted((n for n in counts if 3 * n <= capacity), reverse=True):
            self._fill(length, counts[length])

    def _place(self, length: int, count: int, sequence: int, per: int, offset: int) -> None:
        self.runs.append((length, self.used[length], sequence, per, offset))
        self.used[length] += count

    def _leave(self, gap: int, sequence: int, count: int) -> None:
        if gap and count:
            if gap not in self.open:
                self.open[gap] = []
                bisect.insort(self.gaps, gap)
            self.open[gap].append((sequence, count))

    def _match(self, left: dict[int, int]) -> None:
        """Greedy matching of the pieces over a third: the largest first."""
        lengths = sorted(left)
        while lengths:
            big = lengths[-1]
            at = bisect.bisect_right(lengths, self.capacity - big) - 1
            if at >= 0 and lengths[at] == big and left[big] == 1:
                at -= 1
            partner = lengths[at] if at >= 0 else 0
            if not partner:
                n = left[big]
                self._place(big, n, self.sequences, 1, 0)
            elif partner == big:
                n = left[big] // 2
                self._place(big, 2 * n, self.sequences, 2, 0)
            else:
                n = min(left[big], left[partner])
                self._place(big, n, self.sequences, 1, 0)
                self._place(partner, n, self.sequences, 1, big)
            self._leave(self.capacity - big - partner, self.sequences, n)
            self.sequences += n
            for length in filter(None, (big, partner)):
                left[length] -= n
            for length in {big, partner} - {0}:
                if not left[length]:
                    lengths.remove(length)

    def _fill(self, length: int, count: int) -> None:
        """Best fit of ``count`` pieces. A sequence with the smallest gap that fits has, after
        one piece, again the smallest gap, so it takes pieces until it is too full."""
        while count:
            at = bisect.bisect_left(self.gaps, length)
            if at == len(self.gaps):
                per = self.capacity // length
                gap, sequence, n = self.capacity, self.sequences, -(-count // per)
                self.sequences += n
            else:
                gap = self.gaps[at]
                sequence, n = self.open[gap].pop()
                if not self.open[gap]:
                    del self.open[gap], self.gaps[at]
                per = gap // length
            full = min(n, count // per)
            if full:
                self._place(length, full * per, sequence, per, self.capacity - gap)
                self._leave(gap - per * length, sequence, full)
                count -= full * per
            if full < n and count:
                self._place(length, count, sequence + full, count, self.capacity - gap)
                self._leave(gap - count * length, sequence + full, 1)
                full, count = full + 1, 0
            self._leave(gap, sequence + full, n - full)

    def table(self) -> np.ndarray:
        """The runs by length and first piece: columns length, first, sequence, per, offset."""
        return np.asarray(sorted(self.runs), np.int64).reshape(-1, 5)


def token_pieces(docs: DataFrame, *, key: str = "doc_id", text: str = "text",
                 capacity: int = 2048, end_id: int | None = 0, tokenizer: str | None = None,
                 with_ids: bool = False) -> DataFrame:
    """Per piece: key, piece (from 0), start, length, ids_crc32 and, if asked for, ids as
    little-endian unsigned 32-bit integers.

    A document is its ids and the end id; a null text is empty. Only documents longer than
    ``capacity`` are cut, into pieces of that length and a rest. Repeated rows and null keys
    are packed as often as they come. Other columns are not read.
    """
    spark = docs.sparkSession
    ship_package(spark)
    described = broadcast_tokenizer(spark, tokenizer)

    def make():
        model = encoder(described)

        def pieces(texts: pa.Array) -> pa.Array:
            number, start, length, crc, raw, per = [], [], [], [], [], []
            flat, counts = with_end(*model.encode(texts), end_id)
            data, base = memoryview(np.ascontiguousarray(flat, "<u4")).cast("B"), 0
            for n in counts.tolist():
                cuts = range(0, n, capacity)
                per.append(len(cuts))
                for i, at in enumerate(cuts):
                    size = min(capacity, n - at)
                    one = data[4 * (base + at):4 * (base + at + size)]
                    number.append(i)
                    start.append(at)
                    length.append(size)
                    crc.append(zlib.crc32(one))
                    if with_ids:
                        raw.append(bytes(one))
                base += n
            fields = [pa.array(number, pa.int32()), pa.array(start, pa.int64()),
                      pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
            names = ["piece", "start", "length", "ids_crc32"]
            if with_ids:
                fields.append(pa.array(raw, pa.binary()))
                names.append("ids")
            return list_array(pa.StructArray.from_arrays(fields, names), per)

        return pieces

    kind = ("array<struct<piece:int,start:bigint,length:bigint,ids_crc32:bigint"
            + (",ids:binary>>" if with_ids else ">>"))
    return (docs.select(quoted(key).alias("doc_id"),
                        F.explode(per_array(kind, make)(text_of(text))).alias("p"))
            .select("doc_id", "p.*"))


def placed(pieces: DataFrame, capacity: int) -> DataFrame:
    """Add sequence_id and offset to rows that have a ``length`` from 1 to ``capacity``.

    The rows are written once, so that a piece keeps its number when tasks run again.
    """
    written = stored(pieces, "pieces")
    counts = {r["length"]: r["count"] for r in written.groupBy("length").count().collect()}
    if any(not 1 <= n <= capacity for n in counts):
        raise ValueError(f"lengths must be from 1 to {capacity}")
    plan = pieces.sparkSession.sparkContext.broadcast(Plan(counts, capacity).table())
    numbered = running_total(written, [quoted(c) for c in written.columns],
                             [F.col("length")], F.lit(1), "__number")

    def places(lengths: pa.Array, numbers: pa.Array) -> pa.Array:
        runs = plan.value
        length = lengths.to_numpy(zero_copy_only=False).astype(np.int64)
        number = numbers.to_numpy(zero_copy_only=False).astype(np.int64)
        # Runs of a length follow each other, so the number among all pieces, counted
        # through the lengths, is ordered like the runs.
        kinds, kind = np.unique(runs[:, 0], return_inverse=True)
        whole = np.zeros(len(kinds) + 1, np.int64)
        np.cumsum([counts[n] for n in kinds.tolist()], out=whole[1:])
        at = np.searchsorted(whole[kind] + runs[:, 1],
                             whole[np.searchsorted(kinds, length)] + number, "right") - 1
        within = number - runs[at, 1]
        sequence = runs[at, 2] + within // runs[at, 3]
        offset = runs[at, 4] + within % runs[at, 3] * length
        return pa.StructArray.from_arrays(
            [pa.array(sequence), pa.array(offset)], ["sequence_id", "offset"])

    place: Column = F.arrow_udf(places, returnType="struct<sequence_id:bigint,offset:bigint>")(
        F.col("length"), F.col("__number"))
    return numbered.withColumn("__place", place).select(
        *(quoted(c) for c in written.columns), "__place.*")


def pack_documents(docs: DataFrame, *, capacity: int = 2048, **options) -> DataFrame:
    """Cut documents into pieces and pack them; see ``token_pieces`` and ``placed``."""
    return placed(token_pieces(docs, capacity=capacity, **options), capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """The packed sequences themselves: sequence_id, ids and the length of each piece in it.

    Needs pieces made ``with_ids``. A group holds one sequence, at most ``capacity`` ids.
    """
    part = F.struct("offset", "length", "ids")
    return packed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(part)).alias("p")).select(
        "sequence_id",
        F.aggregate("p", F.lit(b""), lambda done, one: F.concat(done, one["ids"])).alias("ids"),
        F.transform("p", lambda one: one["length"]).alias("lengths"))
