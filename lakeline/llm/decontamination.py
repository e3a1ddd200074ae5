"""Passages of benchmark items inside documents, found through an FM-index per shard of texts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeline.llm.arrow import (
    batches_of,
    list_array,
    per_array,
    quoted,
    ship_package,
    slices_of,
    utf8,
)
from lakeline.llm.fm_index import FmIndex

#: Bytes of text that one index covers, and bytes of benchmark text in one broadcast. A larger
#: benchmark becomes several broadcasts, each searched in the same pass over the documents.
SHARD_BYTES, ITEM_BYTES = 4_000_000, 16_000_000
#: Items in the lists that are made or handed back at a time; a longer list is alone.
LIST_ITEMS = 500_000

#: A-Z lowered; ASCII that is neither letter nor digit becomes a blank; the rest stays.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32
              for b in range(256))


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(_FOLD).split() if text else []


def slices(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The places of all slices, one after the other."""
    return np.repeat(starts - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())


def equal_slices(values: np.ndarray, starts: np.ndarray,
                 lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One slice of each kind of equal slices, and the kind of each slice.

    Slices of one, two, four, .. values get numbers from the numbers of their halves; a length is
    put together from these. So the memory is a few numbers per value, however long slices are.
    """
    part, step = values.astype(np.int64), 1
    kind, done = np.zeros(len(starts), np.int64), starts.astype(np.int64)
    longest = int(lengths.max(initial=0))
    while step <= longest:
        has = np.flatnonzero(lengths & step)
        pair = kind[has] * (int(part.max()) + 1) + part[done[has]]
        kind[has] = np.unique(pair, return_inverse=True)[1]
        done[has] += step
        beside = np.zeros(len(part), np.int64)
        beside[:len(part) - step] = part[step:]
        step *= 2
        if step <= longest:
            part = np.unique(part * (int(part.max()) + 1) + beside, return_inverse=True)[1]
    _, one, kind = np.unique(lengths * (len(starts) + 1) + kind, return_index=True,
                             return_inverse=True)
    return one, kind


class Phrases:
    """The distinct windows of some items, as slices of one sequence of word numbers, and for
    each the number of the set of items that hold it."""

    def __init__(self, items: list[tuple[str, bytes | None]], width: int):
        self.vocabulary: dict[bytes, int] = {}
        names: dict[str, int] = {}
        texts, owners = [], []
        for name, text in items:
            words = words_of(text)
            if words:
                # 0 is the end mark of an index, 1 stands for all other words.
                texts.append(np.fromiter((self.vocabulary.setdefault(w, len(self.vocabulary) + 2)
                                          for w in words), np.int32, len(words)))
                owners.append(names.setdefault(name, len(names)))
        self.names = list(names)
        sizes = np.asarray([len(t) for t in texts], np.int64)
        self.words = np.concatenate([np.zeros(0, np.int32), *texts])
        counts = np.maximum(sizes - width, 0) + 1
        starts = slices(np.cumsum(sizes) - sizes, counts)
        lengths = np.repeat(np.minimum(sizes, width), counts)
        one, window = equal_slices(self.words, starts, lengths)
        self.starts, self.lengths = starts[one].astype(np.int32), lengths[one].astype(np.int32)
        # Windows of a template are in the same items: a set is kept once.
        owner = np.repeat(np.asarray(owners, np.int64), counts)
        window, owner = np.divmod(np.unique(window * len(names) + owner), max(len(names), 1))
        held = np.bincount(window, minlength=len(one))
        begin = np.cumsum(held) - held
        first, kind = equal_slices(owner, begin, held)
        self.set_of = kind.astype(np.int32)
        self.set_counts = held[first]
        self.set_starts = np.cumsum(self.set_counts) - self.set_counts
        self.set_items = owner[slices(begin[first], self.set_counts)].astype(np.int32)

    def find(self, texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
        """(text, from, to) of merged spans of words, and distinct (text, set of items) pairs.

        A window lies inside a run of benchmark words, so only runs as long as the shortest
        window are indexed, each closed by a symbol that is in no window.
        """
        none = np.zeros((0, 3), np.int64), np.zeros((0, 2), np.int64)
        if not len(self.lengths):
            return none
        get, sizes = self.vocabulary.get, np.asarray([len(t) + 1 for t in texts], np.int64)
        numbers = np.fromiter((get(w, 1) for t in texts for w in (*t, b" ")), np.int32, sizes.sum())
        ends = np.flatnonzero(numbers == 1)
        run = np.diff(ends, prepend=-1) - 1
        kept = run >= self.lengths.min()
        run, ends = run[kept], ends[kept]
        if not len(run):
            return none
        origin = slices(ends - run, run + 1)
        index = FmIndex(numbers[origin], len(self.vocabulary) + 2)
        low, high = index.search_in(self.words, self.starts, self.lengths)
        found = np.flatnonzero(high > low)
        times = high[found] - low[found]
        window = np.repeat(found, times)
        at = origin[index.locate(slices(low[found], times))]
        first = np.cumsum(sizes) - sizes
        text = np.searchsorted(first, at, "right") - 1
        n_sets = len(self.set_counts)
        pairs = np.unique(text * n_sets + self.set_of[window])
        return self._merged(text, at - first[text], self.lengths[window]), np.stack(
            np.divmod(pairs, n_sets), 1)

    def items_of(self, pairs: np.ndarray, n_texts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The distinct lists of items that texts have, as numbers and lengths, and the list of
        each text. Texts that meet the same sets share a list."""
        n = np.bincount(pairs[:, 0], minlength=n_texts)
        begin = np.cumsum(n) - n
        one, of = equal_slices(pairs[:, 1], begin, n)
        sets = pairs[slices(begin[one], n[one]), 1]
        which = np.repeat(np.arange(len(one)), n[one])
        numbers, counts = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        # Sets of one list may overlap, so lists are made some at a time.
        sizes = np.bincount(which, self.set_counts[sets], minlength=len(one)).astype(np.int64)
        for part in slices_of(sizes.tolist(), LIST_ITEMS):
            a, b = np.searchsorted(which, [part.start, part.stop])
            held = self.set_counts[sets[a:b]]
            item = self.set_items[slices(self.set_starts[sets[a:b]], held)]
            both = np.unique((np.repeat(which[a:b], held) - part.start) * len(self.names) + item)
            listed, item = np.divmod(both, max(len(self.names), 1))
            numbers.append(item)
            counts.append(np.bincount(listed, minlength=part.stop - part.start))
        return np.concatenate(numbers), np.concatenate(counts), of

    @staticmethod
    def _merged(text: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Spans that overlap or touch become one."""
        by = np.lexsort((start, text))
        text, start, stop = text[by], start[by], (start + length)[by]
        # Texts are kept apart by a shift that is larger than any place in a text.
        shift = text * (int(stop.max(initial=0)) + 2)
        reach = np.maximum.accumulate(stop + shift)
        new = np.append(True, (start + shift)[1:] > reach[:-1]) if len(by) else np.zeros(0, bool)
        begin = np.flatnonzero(new)
        last = np.append(begin[1:], len(by)) - 1 if len(begin) else begin
        return np.stack([text[begin], start[begin], reach[last] - shift[begin]], 1)


def phrase_blocks(items: DataFrame, key: str, text: str, width: int,
                  block_bytes: int) -> Iterator[Phrases]:
    """The items in blocks of at most ``block_bytes`` of text (or one longer item)."""
    block, size = [], 0
    rows = items.select(F.coalesce(quoted(key).cast("string"), F.lit("null")), utf8(text))
    for name, one in rows.toLocalIterator():
        if block and size + len(one or b"") > block_bytes:
            yield Phrases(block, width)
            block, size = [], 0
        block.append((name, bytes(one) if one is not None else None))
        size += len(one or b"")
    yield Phrases(block, width)


_KIND = "struct<n_words:bigint,spans:array<struct<start:bigint,stop:bigint>>,items:array<string>>"


def _finder(spark: SparkSession, phrases: Phrases):
    shared = spark.sparkContext.broadcast(phrases)

    def make():
        def find(texts: pa.Array) -> Iterator[pa.Array]:
            values, phrases = texts.to_pylist(), shared.value
            names = pa.array(phrases.names, pa.string())
            for part in batches_of(values, SHARD_BYTES):
                lists = [words_of(t) for t in values[part]]
                span, pairs = phrases.find(lists)
                n_spans = np.bincount(span[:, 0], minlength=len(lists))
                upto = np.concatenate([[0], np.cumsum(n_spans)])
                item, counts, of = phrases.items_of(pairs, len(lists))
                # A list that many texts share is written out for some of them at a time.
                for rows in slices_of(counts[of].tolist(), LIST_ITEMS):
                    some = of[rows]
                    begin = (np.cumsum(counts) - counts)[some]
                    flat = span[upto[rows.start]:upto[rows.stop], 1:]
                    yield pa.StructArray.from_arrays([
                        pa.array([len(words) for words in lists[rows]], pa.int64()),
                        list_array(pa.StructArray.from_arrays(
                            [pa.array(flat[:, 0]), pa.array(flat[:, 1])], ["start", "stop"]),
                            n_spans[rows]),
                        list_array(names.take(pa.array(item[slices(begin, counts[some])])),
                                   counts[some]),
                    ], ["n_words", "spans", "items"])

        return find

    return per_array(_KIND, make)


def _cutter(spark: SparkSession, blocks: Iterator[Phrases]):
    shared = [spark.sparkContext.broadcast(phrases) for phrases in blocks]

    def make():
        def found(texts: list[list[bytes]]) -> np.ndarray:
            """Spans of the windows of all blocks, in the texts as they are."""
            span = np.concatenate([phrases.value.find(texts)[0] for phrases in shared])
            return Phrases._merged(span[:, 0], span[:, 1], span[:, 2] - span[:, 1])

        def cut(texts: pa.Array) -> pa.Array:
            values = texts.to_pylist()
            for part in batches_of(values, SHARD_BYTES):
                left = np.arange(part.start, part.stop)
                # What a cut brings together may be a window too, of any block.
                while len(left):
                    span = found([words_of(values[i]) for i in left])
                    hit, first = np.unique(span[:, 0], return_index=True)
                    for i, of in zip(left[hit], np.split(span[:, 1:], first[1:])):
                        values[i] = without_spans(values[i], of.tolist())
                    left = left[hit]
            return pa.array(values, pa.binary())

        return cut

    # Or else a filter on the cut text and the text itself would each search for it.
    return per_array("binary", make).asNondeterministic()


def without_contamination(docs: DataFrame, items: DataFrame, *, text: str = "text",
                          item_key: str = "item_id", item_text: str = "text", width: int = 10,
                          item_bytes: int = ITEM_BYTES) -> Column:
    """The text of ``docs`` without the words of all spans, as a column; null stays null.

    Cutting is repeated until no window of any item is left; each round cuts the spans of all
    blocks of items at once, so blocks do not change the result. Texts without a window come
    back unchanged. A worker holds all blocks, see ``contamination``.
    """
    spark = docs.sparkSession
    ship_package(spark)
    blocks = phrase_blocks(items, item_key, item_text, width, item_bytes)
    return _cutter(spark, blocks)(utf8(text)).cast("string")


def _merge_two(a: Column, b: Column) -> Column:
    """One list of spans from two, overlaps and neighbours joined."""
    both = F.array_sort(F.concat(a, b))

    def add(done: Column, one: Column) -> Column:
        last = F.element_at(done, -1)
        longer = F.struct(last["start"].alias("start"),
                          F.greatest(last["stop"], one["stop"]).alias("stop"))
        return F.when((F.size(done) > 0) & (F.try_element_at(done, F.lit(-1))["stop"]
                                            >= one["start"]),
                      F.concat(F.slice(done, 1, F.size(done) - 1), F.array(longer))).otherwise(
            F.concat(done, F.array(one)))

    empty = F.array().cast("array<struct<start:bigint,stop:bigint>>")
    return F.aggregate(both, empty, add)


def contamination(docs: DataFrame, items: DataFrame, *, text: str = "text",
                  item_key: str = "item_id", item_text: str = "text", width: int = 10,
                  item_bytes: int = ITEM_BYTES) -> Column:
    """A column over ``docs``: struct of n_words, spans (start, stop in words, to be removed,
    merged and in order) and items (distinct ids as text, sorted).

    A window is ``width`` consecutive words of an item; an item of fewer words is one window,
    and one without words matches nothing. A null text has no words and no spans. Items with
    the same id count once, a null id is called ``null``. The benchmark is read block by
    block of ``item_bytes`` of text. The driver makes the windows of one block at a time, as numbers
    in a few times its bytes; a worker holds those of all blocks, so its memory grows with the
    benchmark. Items that share windows share sets, so many items with one window cost a text
    one number, and lists of items are handed back some at a time.
    """
    spark = docs.sparkSession
    ship_package(spark)
    found = [_finder(spark, block)(utf8(text))
             for block in phrase_blocks(items, item_key, item_text, width, item_bytes)]
    spans, names = found[0]["spans"], found[0]["items"]
    for more in found[1:]:
        spans, names = _merge_two(spans, more["spans"]), F.concat(names, more["items"])
    return F.struct(found[0]["n_words"].alias("n_words"), spans.alias("spans"),
                    F.array_sort(F.array_distinct(names)).alias("items"))


def contamination_report(docs: DataFrame, items: DataFrame, *, key: str = "doc_id",
                         **options) -> DataFrame:
    """Per row: key, n_words, n_hit, spans and items. Rows and null keys stay as they came."""
    found = docs.select(quoted(key).alias(key),
                        contamination(docs, items, **options).alias("c")).select(key, "c.*")
    n_hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s["stop"] - s["start"])
    return found.withColumn("n_hit", n_hit)


def without_spans(text: bytes | None, spans: list[tuple[int, int]]) -> bytes | None:
    """The text without the words of these spans; what stood between them stays."""
    if not text or not spans:
        return text
    folded = text.translate(_FOLD)
    starts, stops, at = [], [], 0
    for word in folded.split():
        at = folded.index(word, at)
        starts.append(at)
        at += len(word)
        stops.append(at)
    kept, done = [], 0
    for first, last in spans:
        kept.append(text[done:starts[first]])
        done = stops[last - 1]
    return b"".join([*kept, text[done:]])
