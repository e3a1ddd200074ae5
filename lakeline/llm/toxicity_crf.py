"""Toxic spans and documents by a linear-chain conditional random field over words.

Labels are given per document, the field learns from labelled tokens: a word of a toxic
document is toxic if it, or its beginning, is found in toxic documents and hardly in others.
Two states, toxic or not; what a word says about its state depends on the word alone, so a
worker keeps it for the words it has met.
"""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame

from lakeline.llm.arrow import batches_of, list_array, per_array, ship_package, utf8

#: Hashed features, bytes of a word's beginnings and endings among them.
FEATURES, BEGINNINGS, ENDINGS = 1 << 20, (3, 4, 5, 6, 7), (3, 4)
#: Evidence that makes a beginning or word toxic: log-likelihood ratio and ratio of rates.
EVIDENCE, RATE_RATIO = 25.0, 20.0
#: Min-hashes of a text's pairs of words, how many of them copies share, pairs hashed at a time.
HASHES, COPY_HASHES, BLOCK_PAIRS = 64, 52, 4096
#: Words before and after a labelled word that are learned from with it; segments of clean text.
SEGMENT, CLEAN_SEGMENTS = 24, 12_000
#: Segments of one toxic document, drawn from all that it has, rounds of learning and gradient steps in each.
TOXIC_SEGMENTS, ROUNDS = 20, 3
STEPS, RATE, DECAY = 40, 0.2, 1e-6
#: Labelled rows of each label, and bytes of them, that the driver learns from at most.
TRAIN_ROWS, TRAIN_BYTES = {0: 6000, 1: 3000}, {0: 16_000_000, 1: 10_000_000}
#: Words whose evidence a worker keeps; tokens that a lane of the recursion holds at a time.
CACHE_WORDS, LANE, BLOCK_BYTES = 100_000, 64, 2_000_000
LIMIT = 30.0

_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32
              for b in range(256))


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(_FOLD).split() if text else []


def features(word: bytes) -> list[int]:
    """Hashed features of one word; short words repeat the whole for beginnings they lack."""
    crc = zlib.crc32
    size = FEATURES - 1
    found = [crc(word) & size]
    found += [crc(word[:n], n) & size if len(word) > n else found[0] for n in BEGINNINGS]
    found += [crc(word[-n:], 64 + n) & size if len(word) > n else found[0] for n in ENDINGS]
    return found


_MULTIPLY, _ADD = np.random.default_rng(1).integers(
    1, 1 << 63, (2, HASHES, 1), np.uint64) | np.uint64(1)


def min_hashes(words: list[bytes]) -> np.ndarray:
    """Of each of ``HASHES`` hashes the smallest over pairs of neighbouring words (one word is
    hashed alone). Two texts share as large a part as their sets of pairs do, about."""
    crc = zlib.crc32
    pairs = np.asarray([crc(a + b" " + b) for a, b in zip(words, words[1:])]
                       or [crc(b" ".join(words))], np.uint64)
    least = np.full(HASHES, (1 << 32) - 1, np.uint64)
    for at in range(0, len(pairs), BLOCK_PAIRS):
        hashed = (pairs[at:at + BLOCK_PAIRS] * _MULTIPLY + _ADD) >> np.uint64(32)
        least = np.minimum(least, hashed.min(1))
    return least.astype(np.uint32)


def toxic_marks(sample: list[tuple[bytes, int]]) -> set[bytes]:
    """Words, and beginnings of words (with ``*``), that stand out in toxic documents.

    Copies of a document are no evidence of their own: a text that shares ``COPY_HASHES`` of its
    min-hashes with one that counts, of the same label, does not count.
    """
    counts = Counter(), Counter()
    sizes = [0, 0]
    met = [np.zeros((sum(y == label for _, y in sample), HASHES), np.uint32) for label in (0, 1)]
    for text, label in sample:
        words = words_of(text)
        origin = min_hashes(words)
        if ((met[label][:sizes[label]] == origin).sum(1) >= COPY_HASHES).any():
            continue
        met[label][sizes[label]] = origin
        words = set(words)
        marks = words | {w[:n] + b"*" for w in words for n in BEGINNINGS if len(w) > n}
        counts[label].update(marks)
        sizes[label] += 1
    marks = set()
    for mark, t in counts[1].items():
        c = counts[0][mark]
        if t < 3 or t * sizes[0] < RATE_RATIO * (c + 0.5) * sizes[1]:
            continue
        share = (t + c) / (sizes[0] + sizes[1])
        ratio = 0.0
        for n, size in ((t, sizes[1]), (c, sizes[0])):
            for seen, expected in ((n, share * size), (size - n, (1 - share) * size)):
                ratio += 2 * seen * np.log(seen / expected) if seen else 0.0
        if ratio >= EVIDENCE:
            marks.add(mark)
    return marks


def is_toxic(word: bytes, marks: set[bytes]) -> bool:
    return word in marks or any(word[:n] + b"*" in marks for n in BEGINNINGS if len(word) > n)


class ToxicityField:
    """``weights`` of the features for the toxic state against the other, ``steps`` from state
    to state and ``start``, all as logarithms."""

    def __init__(self, toxic: bool = False):
        """A field that has learned nothing: no word is toxic, or every one is."""
        self.weights = np.zeros(FEATURES, np.float32)
        self.start = np.asarray([-LIMIT, 0.0] if toxic else [0.0, -LIMIT])
        self.steps = np.tile(self.start, (2, 1))
        self.known: dict[bytes, float] = {}

    def __getstate__(self):
        return {**self.__dict__, "known": {}}

    def evidence(self, lists: list[list[bytes]]) -> np.ndarray:
        """What each word says for the toxic state, text after text."""
        get = self.known.get
        values = [v for words in lists for v in map(get, words)]
        gaps = [i for i, v in enumerate(values) if v is None]
        if gaps:
            flat = [w for words in lists for w in words]
            fresh = list({flat[i] for i in gaps})
            rows = np.asarray([features(w) for w in fresh], np.int64)
            found = dict(zip(fresh, self.weights[rows].sum(1).tolist()))
            for i in gaps:
                values[i] = found[flat[i]]
            if len(self.known) + len(found) <= CACHE_WORDS:
                self.known.update(found)
        return np.clip(np.asarray(values, np.float64), -LIMIT, LIMIT)

    def marginals(self, evidence: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """The chance of the toxic state for every token of texts of these lengths.

        Forward-backward, with texts cut into lanes of ``LANE`` tokens: the product of a lane's
        steps, for all lanes at once, then from lane to lane inside each text, then again
        inside the lanes from the vectors that enter them on either side. Sums are exact, and
        the number of steps in sequence grows with the lanes of the longest text.
        """
        if not len(evidence):
            return evidence
        lanes = -(-lengths // LANE)
        text = np.repeat(np.arange(len(lengths)), lanes)
        first = np.cumsum(lanes) - lanes
        number = np.arange(lanes.sum()) - first[text]
        begin = (np.cumsum(lengths) - lengths)[text] + number * LANE
        size = np.minimum(lengths[text] - number * LANE, LANE)
        at = begin[None, :] + np.minimum(np.arange(LANE)[:, None], size[None, :] - 1)
        odds = np.exp(evidence)[at]
        live = np.arange(LANE)[:, None] < size[None, :]
        a = np.exp(self.steps)
        s = np.exp(self.start)
        opens = number == 0
        n = len(text)

        def step(t: int):
            """The four entries of the step into token t of every lane."""
            if t:
                return a[0, 0], a[0, 1], a[1, 0], a[1, 1]
            return (np.where(opens, s[0], a[0, 0]), np.where(opens, s[1], a[0, 1]),
                    np.where(opens, s[0], a[1, 0]), np.where(opens, s[1], a[1, 1]))

        # Products of the lanes, row by row: m[i] is what state i before the lane becomes.
        m = np.zeros((2, 2, n))
        m[0, 0] = m[1, 1] = 1
        for t in range(LANE):
            s00, s01, s10, s11 = step(t)
            new = np.empty_like(m)
            new[:, 0] = m[:, 0] * s00 + m[:, 1] * s10
            new[:, 1] = (m[:, 0] * s01 + m[:, 1] * s11) * odds[t]
            new /= new.sum((0, 1))
            m = np.where(live[t], new, m)
        before = np.zeros((2, n))
        before[0, opens] = 1
        after = np.ones((2, n))
        deep = int(lanes.max())
        for k in range(1, deep):
            lane = first[lanes > k] + k
            v = np.einsum("in,ijn->jn", before[:, lane - 1], m[:, :, lane - 1])
            before[:, lane] = v / v.sum(0)
        for k in range(deep - 2, -1, -1):
            lane = first[lanes > k + 1] + k
            v = np.einsum("ijn,jn->in", m[:, :, lane + 1], after[:, lane + 1])
            after[:, lane] = v / v.sum(0)
        forward = np.empty((LANE, 2, n))
        v = before
        for t in range(LANE):
            s00, s01, s10, s11 = step(t)
            new = np.stack([v[0] * s00 + v[1] * s10, (v[0] * s01 + v[1] * s11) * odds[t]])
            v = np.where(live[t], new / new.sum(0), v)
            forward[t] = v
        chance = np.empty((LANE, n))
        v = after
        for t in range(LANE - 1, -1, -1):
            both = forward[t] * v
            chance[t] = both[1] / both.sum(0)
            s00, s01, s10, s11 = step(t)
            w = v[1] * odds[t]
            new = np.stack([s00 * v[0] + s01 * w, s10 * v[0] + s11 * w])
            v = np.where(live[t], new / new.sum(0), v)
        out = np.empty(len(evidence))
        out[at[live]] = chance[live]
        return out

    def tag(self, texts: list[bytes | None]) -> tuple[np.ndarray, list[list[tuple[int, int]]]]:
        """Each text's score, the largest marginal of its words (0 without words), and where its
        toxic spans are: characters from and to, adjacent toxic words as one."""
        scores, spans = np.zeros(len(texts)), []
        for part in batches_of(texts, BLOCK_BYTES):
            lists = [words_of(t) for t in texts[part]]
            lengths = np.asarray([len(w) for w in lists], np.int64)
            full = np.flatnonzero(lengths)
            chance = self.marginals(self.evidence(lists), lengths[full])
            starts = np.cumsum(lengths[full]) - lengths[full]
            if len(full):
                scores[part.start + full] = np.maximum.reduceat(chance, starts)
            toxic = dict(zip(full.tolist(), np.split(chance >= 0.5, starts[1:])))
            for i, text in enumerate(texts[part]):
                hit = np.flatnonzero(toxic[i]) if i in toxic else ()
                spans.append(_places(text, set(hit.tolist())) if len(hit) else [])
        return scores, spans


def _places(text: bytes, hit: set[int]) -> list[tuple[int, int]]:
    """Character positions of the words with these numbers, neighbours joined."""
    folded, at, out, last = text.translate(_FOLD), 0, [], -2
    for number, word in enumerate(folded.split()):
        at = folded.index(word, at)
        if number in hit:
            stop = at + len(word)
            if last == number - 1:
                out[-1] = (out[-1][0], stop)
            else:
                out.append((at, stop))
            last = number
        at += len(word)
    character = lambda byte: len(text[:byte].decode("utf-8", "replace"))
    return [(character(a), character(b)) for a, b in out]


def _segments(words: list[bytes], hits: list[int]) -> list[slice]:
    """Slices of the words around these places, none twice."""
    out, done = [], 0
    for i in hits:
        if i >= done:
            done = i + SEGMENT // 2
            out.append(slice(max(0, i - SEGMENT // 2), done))
    return out


def _fit(field: ToxicityField, segments: list[list[bytes]], tags: list[list[bool]]) -> None:
    """Maximum likelihood: Adam on the gradient that forward-backward gives, from the weights
    that the field has. The chain's own part is counted from the tags."""
    lengths = np.asarray([len(x) for x in segments], np.int64)
    number: dict[bytes, int] = {}
    which = np.asarray([number.setdefault(w, len(number)) for x in segments for w in x], np.int64)
    rows = np.asarray([features(w) for w in number], np.int64)
    gold = np.asarray([t for one in tags for t in one], bool)
    inner = np.ones(len(gold), bool)
    inner[np.cumsum(lengths) - lengths] = False
    pairs = np.full((2, 2), 0.5)
    np.add.at(pairs, (gold[np.flatnonzero(inner) - 1].astype(int), gold[inner].astype(int)), 1)
    field.steps = np.log(pairs / pairs.sum(1, keepdims=True))
    field.start = np.log(pairs.sum(1) / pairs.sum())
    weights = field.weights.astype(np.float64)
    m, v = np.zeros(FEATURES), np.zeros(FEATURES)
    for step in range(1, STEPS + 1):
        evidence = np.clip(weights[rows].sum(1), -LIMIT, LIMIT)[which]
        wrong = field.marginals(evidence, lengths) - gold
        per_word = np.bincount(which, wrong, len(number)) / len(segments)
        gradient = np.bincount(rows.ravel(), np.repeat(per_word, rows.shape[1]), FEATURES)
        gradient += DECAY * weights
        m += 0.1 * (gradient - m)
        v += 0.01 * (gradient ** 2 - v)
        weights -= RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
    field.weights = weights.astype(np.float32)


def train(sample: list[tuple[bytes, int]], sizes: dict[int, int], seed: int = 7) -> ToxicityField:
    """A field learned from segments of the sample, in ``ROUNDS`` rounds.

    The first has segments around the labelled words of toxic documents and some of the others;
    each later one adds segments around words of the others that the field took for toxic.
    Toxic documents without a labelled word say nothing about their words and are left out.
    Without documents of both labels no word is toxic, or all are if all documents are.
    """
    if not sizes.get(0) or not sizes.get(1):
        return ToxicityField(toxic=bool(sizes.get(1)))
    field, draw = ToxicityField(), np.random.default_rng(seed)
    marks = toxic_marks(sample)
    segments, tags = [], []
    for text in (t for t, label in sample if label):
        words = words_of(text)
        toxic = [is_toxic(w, marks) for w in words]
        parts = _segments(words, [i for i, t in enumerate(toxic) if t])
        if len(parts) > TOXIC_SEGMENTS:
            parts = [parts[i] for i in np.sort(draw.permutation(len(parts))[:TOXIC_SEGMENTS])]
        for part in parts:
            segments.append(words[part])
            tags.append(toxic[part])
    clean = [t for t, label in sample if not label]
    total = sum(-(-len(words_of(t)) // SEGMENT) for t in clean)
    for words in map(words_of, clean):
        for at in range(0, len(words), SEGMENT):
            if draw.random() * total < CLEAN_SEGMENTS:
                segments.append(words[at:at + SEGMENT])
                tags.append([False] * len(segments[-1]))
    if not segments:
        return field
    for again in range(ROUNDS):
        _fit(field, segments, tags)
        if again + 1 < ROUNDS:
            for i in range(0, len(clean), 100):
                lists = [words for words in map(words_of, clean[i:i + 100]) if words]
                lengths = np.asarray([len(words) for words in lists], np.int64)
                chance = field.marginals(field.evidence(lists), lengths)
                for words, one in zip(lists, np.split(chance, np.cumsum(lengths)[:-1])):
                    for part in _segments(words, np.flatnonzero(one > 0.05).tolist()):
                        segments.append(words[part])
                        tags.append([False] * len(words[part]))
            field.known.clear()
    return field


_KIND = "struct<score:double,spans:array<struct<start:bigint,stop:bigint>>>"


def toxicity(docs: DataFrame, field: ToxicityField, text: str = "text") -> Column:
    """A column over ``docs``: struct of score (0 to 1) and spans, the characters from and to
    that are toxic. Null texts and texts without words have score 0 and no spans."""
    ship_package(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(field)

    def make():
        def apply(texts: pa.Array) -> pa.Array:
            scores, spans = shared.value.tag(texts.to_pylist())
            flat = np.asarray([p for one in spans for p in one], np.int64).reshape(-1, 2)
            places = pa.StructArray.from_arrays(
                [pa.array(flat[:, 0]), pa.array(flat[:, 1])], ["start", "stop"])
            return pa.StructArray.from_arrays(
                [pa.array(scores), list_array(places, [len(one) for one in spans])],
                ["score", "spans"])

        return apply

    return per_array(_KIND, make)(utf8(text))
