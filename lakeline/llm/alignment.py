"""Alignment of two tokenizers over the same bytes, and how often the corpus links their ids.

Tokens of both tokenizers tile the same bytes. Every token points to the token that overlaps it
and reaches farthest to the right; following the pointers, doubled in numpy until nothing moves,
leads all tokens of a group to its last one, so groups are what lies between the places where
both tokenizers end a token. Ids are written once; links are counted from them and looked up in
a broadcast table of bounded size, and only links that it lacks are joined.
"""

from __future__ import annotations

import hashlib
import os
import re
from array import array
from collections.abc import Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeline.llm.arrow import (
    list_array,
    per_array,
    quoted,
    ship_package,
    slices_of,
    stored,
    text_of,
)
from lakeline.llm.tokens import gathered

#: Words whose ids one worker keeps, and links of which a worker counts at a time.
CACHE_WORDS, COUNTED_LINKS = 150_000, 1_000_000
#: Tokens of one tokenizer that are aligned at a time; a longer document is alone.
SLICE_TOKENS = 250_000
#: Links in the broadcast table, the ones in most documents: 17 bytes each.
TABLE_LINKS = 1 << 20
#: How the ids are written: as their bytes, in small row groups.
LAYOUT = {"compression": "zstd", "parquet.enable.dictionary": "false",
          "parquet.block.size": str(16 << 20), "parquet.page.size": str(256 << 10)}

#: A blank next to other white space, where a word of its own can't begin.
_ODD = (r"^[\s\x{85}\x{1C}-\x{1F}\p{Z}]|[\s\x{85}\x{1C}-\x{1F}\p{Z}]$"
        r"|[\s\x{85}\x{1C}-\x{1F}\p{Z}] | [\s\x{85}\x{1C}-\x{1F}\p{Z}]")
_BETWEEN = re.compile(r"(?<=\S) (?=\S)")
#: Letters (U+017F and below) that are one pre-token, and ASCII marks that after them are
#: another. RE2 and Python read both alike.
_LETTER = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u017f"
_MARK = r"""!"#$%&()*+,\-./:;<=>?@\[\\\]^_`{|}~"""
_LETTERS, _MARKS = re.compile(f"[{_LETTER}]+"), re.compile(f"[{_MARK}]+")


def default_tokenizers() -> tuple[str, str]:
    import public_tokenizers

    return (public_tokenizers.path("byte_bpe_50k.json"),
            public_tokenizers.path("piece_bpe_32k.model"))


def broadcast_tokenizers(spark: SparkSession, paths: tuple[str, str] | None) -> Broadcast:
    """The files' contents; executors need no copies of them."""
    a, b = paths or default_tokenizers()
    with open(a, encoding="utf-8") as first, open(b, "rb") as second:
        return spark.sparkContext.broadcast((first.read(), second.read()))


def byte_letters() -> dict[int, str]:
    """The letters that stand for bytes in a byte-level vocabulary (a fixed format): printable
    Latin-1 for itself, the others in order from U+0100 on."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + n) for n, b in enumerate(others)}


class PairEncoder:
    """Ids of a text by a byte-level BPE (A, of space and text) and a sentencepiece model (B).

    Neither joins a word to what stands before the single blank that begins it, or letters to
    the marks after them: A's pre-tokens begin there, and no piece of B goes across, which is
    checked when it is loaded. So the ids of a text are those of its words, letters and marks,
    each encoded once per block of texts or found in the worker's cache.
    """

    def __init__(self, a: str, b: bytes, cache_words: int = CACHE_WORDS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(a)
        self.a.encode_special_tokens = True
        self.model = self.a.model
        self.model._resize_cache(0)
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b)
        self.spelled = byte_letters()
        back = {letter: byte for byte, letter in self.spelled.items()}
        vocabulary = self.a.get_vocab()
        self.a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.a_bytes[i] = bytes(back[c] for c in token)
        self.b_bytes = [self._piece(i) for i in range(self.b.get_piece_size())]
        across = re.compile(f"[^\u2581]\u2581|[{_LETTER}][{_MARK}]")
        if any(across.search(self.b.id_to_piece(i)) for i in range(len(self.b_bytes))
               if not (self.b.is_byte(i) or self.b.is_control(i) or self.b.is_unknown(i))):
            raise ValueError("pieces go across the ends of words, so words can't be encoded alone")
        self.a_sizes = np.asarray([len(t) for t in self.a_bytes], np.int64)
        self.b_sizes = np.asarray([len(t) for t in self.b_bytes], np.int64)
        # Ids are kept and written as little-endian unsigned integers of 16 or 32 bits.
        self.kind = "<u2" if max(len(self.a_bytes), len(self.b_bytes)) <= 1 << 16 else "<u4"
        self.cache_words = cache_words
        self.known: tuple[dict[str, bytes], dict[str, bytes]] = {}, {}
        self._labels: tuple[np.ndarray, np.ndarray] | None = None

    def _piece(self, i: int) -> bytes:
        if self.b.is_byte(i):
            return bytes([int(self.b.id_to_piece(i)[3:5], 16)])
        return self.b.id_to_piece(i).replace("▁", " ").encode()

    def _first(self, words: list[str]) -> list[list[int]]:
        """A's ids of a blank and each word."""
        tokenize, spelled, letters = self.model.tokenize, self.spelled, _LETTERS.fullmatch
        out: list[list[int]] = [[]] * len(words)
        other = []
        for i, word in enumerate(words):
            if letters(word):
                out[i] = [t.id for t in tokenize(
                    (b" " + word.encode()).decode("latin-1").translate(spelled))]
            else:
                other.append(i)
        found = self.a.encode_batch_fast([" " + words[i] for i in other],
                                         add_special_tokens=False)
        for i, one in zip(other, found):
            out[i] = one.ids
        return out

    def _encode_words(self, words: list[str]) -> tuple[list[bytes], list[bytes]]:
        """Ids of A and B of a blank and each word; none where they don't spell it."""
        code = "H" if self.kind == "<u2" else "I"
        sides = self._first(words), self.b.encode(words, num_threads=1)
        spelled = [b" " + w.encode() for w in words]
        lengths = np.fromiter(map(len, spelled), np.int64, len(words))
        right = np.ones(len(words), bool)
        for ids, table, sizes in zip(sides, (self.a_bytes, self.b_bytes),
                                     (self.a_sizes, self.b_sizes)):
            flat = np.fromiter(chain.from_iterable(ids), np.int64)
            stops = np.cumsum(np.fromiter(map(len, ids), np.int64, len(ids)))
            size = np.diff(np.append(0, np.cumsum(sizes[flat]))[stops], prepend=0)
            if (np.array_equal(size, lengths)
                    and b"".join(map(table.__getitem__, flat.tolist())) == b"".join(spelled)):
                continue
            right &= np.fromiter((b"".join([table[t] for t in one]) == word
                                  for one, word in zip(ids, spelled)), bool, len(words))
        keep = right.tolist()
        return tuple([array(code, one).tobytes() if k else b"" for one, k in zip(ids, keep)]
                     for ids in sides)

    def word_ids(self, words: list[str]) -> tuple[list[bytes], list[bytes]]:
        """The same from the cache, where it has them; a full cache keeps what it has."""
        ids = tuple(list(map(known.get, words)) for known in self.known)
        gaps = [i for i, one in enumerate(ids[0]) if one is None]
        new = self._encode_words([words[i] for i in gaps]) if gaps else ((), ())
        room = max(0, self.cache_words - len(self.known[0]))
        for own, known, found in zip(ids, self.known, new):
            for i, one in zip(gaps, found):
                own[i] = one
            for i, one in zip(gaps[:room], found):
                known[words[i]] = one
        return ids

    def mark_ids(self, marks: list[str]) -> tuple[list[bytes], list[bytes]]:
        """Ids of marks that stand after letters; none for an empty string."""
        code = "H" if self.kind == "<u2" else "I"
        before = len(self.b.encode("a"))
        first = [[t.id for t in self.model.tokenize(
            m.encode().decode("latin-1").translate(self.spelled))] if m else [] for m in marks]
        second = [self.b.encode("a" + m)[before:] for m in marks]
        return tuple([array(code, one).tobytes() for one in ids] for ids in (first, second))

    def encode(self, texts: pa.Array) -> pa.Array:
        """Per text a struct of the ids of A and of B as bytes; both empty if there is no text,
        or if the ids of either don't spell a blank and the text."""
        texts = pc.fill_null(_valid(texts), "")
        odd = pc.match_substring_regex(texts, _ODD)
        if pc.any(odd).as_py():
            lists = pa.array([_BETWEEN.split(t) if o else t.split(" ")
                              for t, o in zip(texts.to_pylist(), odd.to_pylist())],
                             pa.list_(pa.string()))
        else:
            lists = pc.split_pattern(texts, " ")
        words = lists.flatten().dictionary_encode()
        which, words = words.indices.to_numpy(), words.dictionary
        marked = pc.match_substring_regex(words, f"^[{_LETTER}]+[{_MARK}]+$")
        stems = pc.if_else(marked, pc.replace_substring_regex(words, f"[{_MARK}]+$", ""),
                           words).dictionary_encode()
        marks = pc.if_else(marked, pc.replace_substring_regex(words, f"^[{_LETTER}]+", ""),
                           "").dictionary_encode()
        stem_ids = self.word_ids(stems.dictionary.to_pylist())
        mark_ids = self.mark_ids(marks.dictionary.to_pylist())
        # A word is two parts: its stem, and its marks or nothing.
        parts = np.empty(2 * len(which), np.int64)
        parts[::2] = stems.indices.to_numpy()[which]
        parts[1::2] = marks.indices.to_numpy()[which] + len(stems.dictionary)
        ends = lists.offsets.to_numpy()[1:].astype(np.int64) - lists.offsets[0].as_py()
        wrong = np.fromiter(map(len, stem_ids[0]), np.int64, len(stem_ids[0])) == 0
        bad = np.append(0, np.cumsum(wrong[parts[::2]]))[np.append(0, ends)]
        keep = (np.diff(bad) == 0) & pc.greater(pc.binary_length(texts), 0).to_numpy(
            zero_copy_only=False)
        sides, width = [], np.dtype(self.kind).itemsize
        for stem, mark in zip(stem_ids, mark_ids):
            ids = stem + mark
            at, stops = gathered(np.fromiter(map(len, ids), np.int32, len(ids)) // width, parts)
            counts = np.diff(np.append(0, stops)[2 * ends], prepend=0)
            flat = np.frombuffer(b"".join(ids), self.kind)[at][np.repeat(keep, counts)]
            offsets = np.append(0, np.cumsum(np.where(keep, counts, 0) * width)).astype(np.int32)
            sides.append(pa.Array.from_buffers(pa.binary(), len(counts), [
                None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(flat))]))
        return pa.StructArray.from_arrays(sides, ["a", "b"])

    def labels(self) -> tuple[np.ndarray, np.ndarray]:
        """Ids in decimal behind what parts them from the token before, and their lengths: for
        each id of A, then of B, within a group (``,``) and as the first of its side."""
        if self._labels is None:
            words = [b"%b%d" % (mark, i)
                     for size, first in ((len(self.a_sizes), b";"), (len(self.b_sizes), b"|"))
                     for i in range(size) for mark in (b",", first)]
            lengths = np.fromiter(map(len, words), np.int64, len(words))
            letters = np.asarray(words, "S").view(np.uint8).reshape(len(words), -1)
            self._labels = letters, lengths
        return self._labels


def _valid(texts: pa.Array) -> pa.Array:
    """Bytes that are no UTF-8, which a cast from binary may leave, become the mark for that."""
    try:
        texts.validate(full=True)
        return texts
    except pa.ArrowInvalid:
        raw = texts.cast(pa.binary()).to_pylist()
        return pa.array([None if t is None else t.decode("utf-8", "replace") for t in raw],
                        pa.string())


_encoders: dict[str, PairEncoder] = {}


def encoder(files: Broadcast) -> PairEncoder:
    """The worker's encoder for these tokenizers, kept from task to task."""
    a, b = files.value
    key = hashlib.md5(a.encode() + b).hexdigest()
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = PairEncoder(a, b)
    return _encoders[key]


class Aligned(NamedTuple):
    """Some documents' tokens: the group of each token of A and B (numbered through all), the
    links as numbers of their tokens, and how many groups and links there are up to the end of
    each document."""

    a_group: np.ndarray
    b_group: np.ndarray
    a_link: np.ndarray
    b_link: np.ndarray
    group_ends: np.ndarray
    link_ends: np.ndarray


def align(a_sizes: np.ndarray, b_sizes: np.ndarray, a_counts: np.ndarray) -> Aligned:
    """Align the tokens of documents that stand one after the other, by their sizes in bytes.

    ``a_counts``: tokens of A in each document. The sizes of a document's tokens have the same
    sum for A and B.
    """
    a_end, b_end = np.cumsum(a_sizes), np.cumsum(b_sizes)
    n, size = len(a_end), int(a_end[-1]) if len(a_end) else 0
    a_at, b_at = np.zeros(size + 1, bool), np.zeros(size + 1, bool)
    a_at[a_end], b_at[b_end] = True, True
    # How many tokens end up to a place is the number of the token that has the byte there.
    a_upto, b_upto = np.cumsum(a_at, dtype=np.int32), np.cumsum(b_at, dtype=np.int32)
    over_a, over_b = b_upto[a_end - 1], a_upto[b_end - 1]
    # A token of A that ends with one of B is a last one; that of B points to it.
    last = b_at[a_end]
    points = np.concatenate([np.where(last, np.arange(n), n + over_a), over_b])
    while True:
        farther = points[points]
        if np.array_equal(farther, points):
            break
        points = farther
    number = np.cumsum(last) - 1  # of the group that a last token ends
    a_group, b_group = number[points[:n]], number[points[n:]]
    # Every byte range between two ends is the overlap of one pair of tokens.
    both = a_at | b_at
    ends = np.flatnonzero(both)
    a_link, b_link = a_upto[ends - 1], b_upto[ends - 1]
    a_stops = np.cumsum(a_counts)
    bytes_to = np.append(0, a_end)[a_stops]
    return Aligned(a_group, b_group, a_link, b_link, np.append(0, np.cumsum(last))[a_stops],
                   np.cumsum(both)[bytes_to])


def _sliced(one: PairEncoder, rows: pa.StructArray) -> Iterator[tuple[
        np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Ids of A and B and how many each document has, for slices of written rows."""
    sides, width = rows.flatten(), np.dtype(one.kind).itemsize
    counts = [pc.binary_length(s).to_numpy(zero_copy_only=False) // width for s in sides]
    for part in slices_of(counts[0].tolist(), SLICE_TOKENS):
        flat = [np.frombuffer(b"".join(s[part].to_pylist()), one.kind) for s in sides]
        yield *flat, *(c[part].astype(np.int64) for c in counts)


def _links(a: np.ndarray, b: np.ndarray, found: Aligned, kinds: int) -> np.ndarray:
    """The pair of ids of each link as one number."""
    return a[found.a_link].astype(np.int64) * kinds + b[found.b_link]


def encoded(docs: DataFrame, *, key: str = "doc_id", text: str = "text",
            tokenizers: tuple[str, str] | None = None) -> DataFrame:
    """Write (doc_id, a, b): the ids of every text by both tokenizers, as their bytes.

    Null and empty texts, and those whose tokens don't spell a blank and the text, have none.
    Repeated rows and null keys are rows like others; other columns are not read.
    """
    spark = docs.sparkSession
    ship_package(spark)
    files = broadcast_tokenizers(spark, tokenizers)

    def make():
        return encoder(files).encode

    ids = per_array("struct<a:binary,b:binary>", make)(text_of(text))
    return stored(docs.select(quoted(key).alias("doc_id"), ids.alias("ids")).select(
        "doc_id", "ids.a", "ids.b"), "aligned-ids", **LAYOUT)


def _pieces(files: Broadcast) -> int:
    """Size of B's vocabulary."""
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_proto=files.value[1]).get_piece_size()


def link_counts(written: DataFrame, files: Broadcast) -> DataFrame:
    """``pair`` (A's id times the size of B's vocabulary, and B's id), ``n``, the documents that
    hold it linked, and ``best``: no other link of A's id is in more. Written."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = encoder(files)
        kinds, held = len(one.b_sizes), []

        def summed(done: list) -> tuple[np.ndarray, np.ndarray]:
            pairs, back = np.unique(np.concatenate([p for p, _ in done]), return_inverse=True)
            total = np.zeros(len(pairs), np.int64)
            np.add.at(total, back, np.concatenate([n for _, n in done]))
            return pairs, total

        def made(pairs: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
            return pa.record_batch([pa.array(pairs), pa.array(counts)], ["pair", "n"])

        for batch in batches:
            for a, b, a_counts, _ in _sliced(one, pa.StructArray.from_arrays(
                    batch.columns, ["a", "b"])):
                if not len(a):
                    continue
                found = align(one.a_sizes[a], one.b_sizes[b], a_counts)
                pairs = _links(a, b, found, kinds)
                doc = np.repeat(np.arange(len(a_counts)), np.diff(found.link_ends, prepend=0))
                # Once for each document, and then how many documents.
                span = len(one.a_sizes) * kinds
                held.append(np.unique(np.unique(doc * span + pairs) % span, return_counts=True))
                if sum(len(p) for p, _ in held) > COUNTED_LINKS:
                    held = [summed(held)]
                    if len(held[0][0]) > COUNTED_LINKS // 2:
                        yield made(*held.pop())
        if held:
            yield made(*summed(held))

    counts = (written.select("a", "b").mapInArrow(count, "pair bigint, n bigint")
              .groupBy("pair").agg(F.sum("n").alias("n")))
    counts = stored(counts, "link-counts")
    a = F.floor(F.col("pair") / F.lit(_pieces(files)))
    most = counts.groupBy(a.alias("a")).agg(F.max("n").alias("most"))
    return stored(counts.withColumn("a", a).join(most, "a").select(
        "pair", "n", (F.col("n") == F.col("most")).alias("best")), "links")


def _table(links: DataFrame, limit: int) -> tuple[Broadcast, bool]:
    """The links that most documents hold, ``limit`` at most, as arrays by pair; and whether
    these are all. Which ones is told by a histogram of the counts, in steps of a sixteenth of
    a power of two."""
    step = F.floor(F.log2("n") * 16)
    steps = sorted(links.groupBy(step.alias("s")).count().collect(), reverse=True)
    size, least = 0, None
    for s, rows in steps:
        if size + rows > limit:
            break
        size, least = size + rows, s
    chosen = links.where(step >= least) if least is not None else links.limit(0)
    rows = chosen.select("pair", "n", "best").toArrow()
    order = np.argsort(rows["pair"].to_numpy())
    made = links.sparkSession.sparkContext.broadcast(
        tuple(rows[c].to_numpy()[order] for c in ("pair", "n", "best")))
    return made, not steps or (least is not None and least == steps[-1][0])


def _group_text(one: PairEncoder, a: np.ndarray, b: np.ndarray, found: Aligned,
                a_counts: np.ndarray, b_counts: np.ndarray) -> list[memoryview]:
    """Per document ``a1,a2|b1;a3|b2,b3``: ids of A and B, group by group."""
    a_first = np.diff(found.a_group, prepend=-1) != 0
    b_first = np.diff(found.b_group, prepend=-1) != 0
    groups = int(found.a_group[-1]) + 1 if len(a) else 0
    per_a = np.cumsum(np.bincount(found.a_group, minlength=groups))
    per_b = np.append(0, np.cumsum(np.bincount(found.b_group, minlength=groups)))
    # A token's place: those of its side before it, and those of the other side's groups.
    codes = np.empty(len(a) + len(b), np.int64)
    codes[np.arange(len(a)) + per_b[found.a_group]] = 2 * a.astype(np.int64) + a_first
    codes[np.arange(len(b)) + per_a[found.b_group]] = (
        2 * (len(one.a_sizes) + b.astype(np.int64)) + b_first)
    letters, lengths = one.labels()
    text = letters[codes][np.arange(letters.shape[1]) < lengths[codes][:, None]]
    data = memoryview(text)
    stops = np.append(0, np.cumsum(lengths[codes]))[np.cumsum(a_counts + b_counts)].tolist()
    return [data[i + 1:j] for i, j in zip([0, *stops], stops)]


_REPORT = ("n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, "
           "count_sum bigint, groups_sha256 string")


def _report(one: PairEncoder, table: tuple, rows: pa.StructArray) -> pa.Array:
    """The digest of each document, and its links that the table lacks, with their numbers."""
    keys, totals, bests = table
    columns: list[list[np.ndarray]] = [[np.zeros(0, np.int64)] for _ in range(6)]
    hashes: list[str] = []
    rare = [[np.zeros(0, np.int64)] for _ in range(3)]
    for a, b, a_counts, b_counts in _sliced(one, rows):
        found = align(one.a_sizes[a], one.b_sizes[b], a_counts)
        pairs, back = np.unique(_links(a, b, found, len(one.b_sizes)), return_inverse=True)
        at = np.minimum(np.searchsorted(keys, pairs), max(0, len(keys) - 1))
        hit = keys[at] == pairs if len(keys) else np.zeros(len(pairs), bool)
        n = np.where(hit, totals[at], 0) if len(keys) else np.zeros(len(pairs), np.int64)
        best = (hit & bests[at]).astype(np.int64) if len(keys) else n
        ends = found.link_ends

        def per_document(values: np.ndarray) -> np.ndarray:
            return np.diff(np.append(0, np.cumsum(values[back]))[ends], prepend=0)

        for column, values in zip(columns, (
                a_counts, b_counts, np.diff(found.group_ends, prepend=0),
                np.diff(ends, prepend=0), per_document(best), per_document(n))):
            column.append(values)
        hashes += [hashlib.sha256(t).hexdigest() if len(t) else ""
                   for t in _group_text(one, a, b, found, a_counts, b_counts)]
        doc = np.repeat(np.arange(len(a_counts)), np.diff(ends, prepend=0))
        missed = ~hit[back]
        kinds = max(1, len(pairs))
        each, times = np.unique(doc[missed] * kinds + back[missed], return_counts=True)
        rare[0].append(np.bincount(each // kinds, minlength=len(a_counts)))
        rare[1].append(pairs[each % kinds] if len(each) else np.zeros(0, np.int64))
        rare[2].append(times)
    fields = [pa.array(np.concatenate(c), pa.int64()) for c in columns]
    lists = list_array(pa.StructArray.from_arrays(
        [pa.array(np.concatenate(c), pa.int64()) for c in rare[1:]], ["pair", "times"]),
        np.concatenate(rare[0]))
    names = [c.split()[0] for c in _REPORT.split(", ")]
    return pa.StructArray.from_arrays(
        [*fields, pa.array(hashes, pa.string()), lists], [*names, "rare"])


def alignment_report(docs: DataFrame, *, key: str = "doc_id", text: str = "text",
                     tokenizers: tuple[str, str] | None = None,
                     table_links: int = TABLE_LINKS) -> DataFrame:
    """Per row: ``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``.

    Tokens of both tokenizers are linked where their bytes overlap; groups lie between the
    places where both end a token. The count of a link is the number of rows that hold its pair
    of ids linked; ``n_best`` counts links of which no other link of A's id has a higher count,
    ``count_sum`` adds the counts of all links. Rows without tokens (see ``encoded``) have zeros
    and an empty ``groups_sha256``, an empty table has no rows, and repeated rows count as
    often as they come. ``table_links`` bounds the broadcast table and no result: links that it
    lacks are joined with their counts.
    """
    spark = docs.sparkSession
    files = broadcast_tokenizers(spark, tokenizers)
    written = encoded(docs, key=key, text=text, tokenizers=tokenizers)
    links = link_counts(written, files)
    table, whole = _table(links, table_links)

    def make():
        one = encoder(files)
        return lambda rows: _report(one, table.value, rows)

    kind = ("struct<" + ",".join(c.replace(" ", ":") for c in _REPORT.split(", "))
            + ",rare:array<struct<pair:bigint,times:bigint>>>")
    place = F.struct(F.col("_metadata.file_name").alias("f"),
                     F.col("_metadata.row_index").alias("i"))
    names = [c.split()[0] for c in _REPORT.split(", ")]
    rows = written.select("doc_id", place.alias("place"),
                          per_array(kind, make)(F.struct("a", "b")).alias("r"))
    if whole:
        return rows.select("doc_id", *(F.col("r")[c].alias(c) for c in names))
    rows = stored(rows, "alignment")
    missed = rows.select("place", F.explode("r.rare").alias("m")).select("place", "m.*")
    more = missed.join(links, "pair").groupBy("place").agg(
        F.sum(F.col("n") * F.col("times")).alias("more"),
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_best"))
    added = {"n_best": "more_best", "count_sum": "more"}
    return rows.join(more, "place", "left").select(
        "doc_id", *((F.col("r")[c] + F.coalesce(F.col(added[c]), F.lit(0)) if c in added
                     else F.col("r")[c]).alias(c) for c in names))


def token_groups(docs: DataFrame, *, key: str = "doc_id", text: str = "text",
                 tokenizers: tuple[str, str] | None = None) -> DataFrame:
    """The alignment itself: ``doc_id, a, b`` (the ids) and ``a_group, b_group``, the group of
    each token, from 0 in each document."""
    spark = docs.sparkSession
    files = broadcast_tokenizers(spark, tokenizers)
    written = encoded(docs, key=key, text=text, tokenizers=tokenizers)

    def make():
        one = encoder(files)

        def groups(rows: pa.StructArray) -> pa.Array:
            lists = [[np.zeros(0, np.int32)] for _ in range(4)]
            counts = [[np.zeros(0, np.int64)] for _ in range(2)]
            for a, b, *sizes in _sliced(one, rows):
                found = align(one.a_sizes[a], one.b_sizes[b], sizes[0])
                first = np.append(0, found.group_ends)[:-1]
                for held, values in zip(lists, (
                        a, b, found.a_group - np.repeat(first, sizes[0]),
                        found.b_group - np.repeat(first, sizes[1]))):
                    held.append(values.astype(np.int32))
                for held, values in zip(counts, sizes):
                    held.append(values)
            sizes = [np.concatenate(c) for c in counts]
            return pa.StructArray.from_arrays(
                [list_array(np.concatenate(v), sizes[k % 2]) for k, v in enumerate(lists)],
                names)

        return groups

    names = ["a", "b", "a_group", "b_group"]
    kind = "struct<" + ",".join(f"{n}:array<int>" for n in names) + ">"
    return written.select("doc_id", per_array(kind, make)(F.struct("a", "b")).alias("g")).select(
        "doc_id", "g.*")
