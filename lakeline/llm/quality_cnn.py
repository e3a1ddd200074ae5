"""Quality of a text by a small convolutional network over its bytes, in numpy.

Bytes are embedded, filters of ``WIDTH`` bytes run over all of the text, and chunks of
``2 * HALF`` bytes that overlap by half keep each filter's largest value. A text is the mean
and the largest of its chunks, and a logistic unit makes one probability of them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame

from lakeline.llm.arrow import batches_of, per_array, ship_package, utf8

WIDTH, STEP, HALF = 8, 2, 128
EMBEDDING, FILTERS = 6, 16
BLOCK_BYTES = 500_000
NOTHING = np.float32(-1e9)
EPOCHS, BATCH_BYTES, RATE = 12, 60_000, 0.01
#: Labelled rows of each label, and bytes of them, that the driver learns from at most.
TRAIN_ROWS, TRAIN_BYTES = {0: 2000, 1: 2000}, {0: 6_000_000, 1: 6_000_000}


def padded(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The texts one after the other, each filled with zero bytes to whole half chunks (one at
    least), the number of half chunks of each, and how many bytes of its last are text."""
    halves = np.asarray([max(1, -(-len(t) // HALF)) for t in texts], np.int64)
    filled = b"".join(t.ljust(n * HALF, b"\0") for t, n in zip(texts, halves.tolist()))
    last = np.asarray([len(t) for t in texts], np.int64) - (halves - 1) * HALF
    return np.frombuffer(filled, np.uint8), halves, last


def without_fill(out: np.ndarray, halves: np.ndarray, last: np.ndarray) -> None:
    """Windows that begin after the text never are the largest."""
    rows = np.cumsum(halves) - 1
    out[rows] = np.where((np.arange(out.shape[1]) * STEP >= last[:, None])[:, :, None],
                         NOTHING, out[rows])


class ByteNet:
    def __init__(self, seed: int = 7):
        draw = np.random.default_rng(seed)
        self.embedding = draw.normal(0, 0.5, (256, EMBEDDING)).astype(np.float32)
        self.filters = draw.normal(0, 0.3, (WIDTH * EMBEDDING, FILTERS)).astype(np.float32)
        self.bias = np.zeros(FILTERS, np.float32)
        self.weights = draw.normal(0, 0.1, 2 * FILTERS).astype(np.float32)
        self.offset = np.zeros(1, np.float32)

    def parameters(self) -> list[np.ndarray]:
        return [self.embedding, self.filters, self.bias, self.weights, self.offset]

    def _windows(self, data: np.ndarray, halves: np.ndarray) -> np.ndarray:
        """Embedded windows of every place, (half chunks, places, values). Windows at the end
        of a text see zero bytes, never the next text."""
        rows = data.reshape(-1, HALF)
        after = np.zeros((len(rows), WIDTH - STEP), np.uint8)
        after[:-1] = rows[1:, :WIDTH - STEP]
        after[np.cumsum(halves) - 1] = 0
        whole = self.embedding[np.concatenate([rows, after], 1)]
        size = whole.itemsize
        return np.lib.stride_tricks.as_strided(
            whole, (len(rows), HALF // STEP, WIDTH * EMBEDDING),
            (whole.strides[0], STEP * EMBEDDING * size, size))

    def _pooled(self, data: np.ndarray, halves: np.ndarray):
        windows = self._windows(data, halves)
        out = windows.reshape(-1, WIDTH * EMBEDDING) @ self.filters
        return windows, out.reshape(len(windows), -1, FILTERS)

    def _chunks(self, half: np.ndarray, halves: np.ndarray):
        """Chunks of two half chunks; a text of one half chunk is one chunk."""
        n = np.maximum(halves - 1, 1)
        stop = np.cumsum(halves)
        first = np.repeat(stop - halves - np.cumsum(n) + n, n) + np.arange(n.sum())
        second = np.minimum(first + 1, np.repeat(stop - 1, n))
        return first, second, n, np.maximum(np.maximum(half[first], half[second]) + self.bias, 0)

    def _document(self, chunk: np.ndarray, n: np.ndarray) -> np.ndarray:
        starts = np.cumsum(n) - n
        return np.concatenate([np.add.reduceat(chunk, starts) / n[:, None],
                               np.maximum.reduceat(chunk, starts)], 1)

    def score(self, texts: list[bytes | None]) -> np.ndarray:
        """One probability per text; a null text is an empty one."""
        out = []
        for part in batches_of(texts, BLOCK_BYTES):
            data, halves, last = padded([t or b"" for t in texts[part]])
            pools = []
            limit = BLOCK_BYTES // HALF
            # A text longer than a block is convolved piece by piece, each with one more half
            # chunk for the windows that reach beyond the piece.
            for at in range(0, len(data) // HALF, limit):
                rows = data[at * HALF:(at + limit + 1) * HALF]
                ends = np.cumsum(halves) - at
                inside = (ends > 0) & (ends <= len(rows) // HALF)
                ends, rest = ends[inside], last[inside]
                if not len(ends) or ends[-1] < len(rows) // HALF:
                    ends, rest = np.append(ends, len(rows) // HALF), np.append(rest, HALF)
                pieces = np.diff(ends, prepend=0)
                pooled = self._pooled(rows, pieces)[1]
                without_fill(pooled, pieces, rest)
                pools.append(pooled.max(1)[:limit])
            *_, n, chunk = self._chunks(np.concatenate(pools), halves)
            z = self._document(chunk, n) @ self.weights + self.offset
            out.append(1 / (1 + np.exp(-z.astype(np.float64))))
        return np.concatenate(out) if out else np.zeros(0)

    def gradients(self, texts: list[bytes], labels: np.ndarray) -> list[np.ndarray]:
        data, halves, last = padded(texts)
        windows, out = self._pooled(data, halves)
        without_fill(out, halves, last)
        place = out.argmax(1)
        half = np.take_along_axis(out, place[:, None], 1)[:, 0]
        first, second, n, chunk = self._chunks(half, halves)
        doc = self._document(chunk, n)
        wrong = (1 / (1 + np.exp(-(doc @ self.weights + self.offset))) - labels) / len(labels)
        to_doc = wrong[:, None] * self.weights
        owner = np.repeat(np.arange(len(n)), n)
        to_chunk = to_doc[owner, :FILTERS] / n[owner, None]
        largest = chunk == doc[owner, FILTERS:]
        # Of equal chunks the first gets the gradient of the largest.
        seen = np.cumsum(largest, 0)
        starts = np.cumsum(n) - n
        before = (seen - largest)[starts][owner]
        largest &= seen - before == 1
        to_chunk = (to_chunk + largest * to_doc[owner, FILTERS:]) * (chunk > 0)
        to_half = np.zeros_like(half)
        left = half[first] >= half[second]
        np.add.at(to_half, first, to_chunk * left)
        np.add.at(to_half, second, to_chunk * ~left)
        used = windows[np.arange(len(half))[:, None], place]
        to_filters = np.einsum("sf,sfd->df", to_half, used, optimize=True)
        to_windows = (to_half[:, :, None] * self.filters.T[None]).reshape(
            len(half), FILTERS, WIDTH, EMBEDDING)
        at = (np.arange(len(half))[:, None] * HALF + place * STEP)[:, :, None] + np.arange(WIDTH)
        reach = np.repeat(np.cumsum(halves), halves)[:, None, None] * HALF
        symbol = np.where(at < reach, data[np.minimum(at, len(data) - 1)], 0)
        to_embedding = np.zeros_like(self.embedding)
        for d in range(EMBEDDING):
            to_embedding[:, d] = np.bincount(symbol.ravel(), to_windows[..., d].ravel(), 256)
        return [to_embedding, to_filters.astype(np.float32), to_chunk.sum(0),
                (wrong @ doc).astype(np.float32), wrong.sum(keepdims=True)]


def train(sample: list[tuple[bytes, int]], sizes: dict[int, int], seed: int = 7) -> ByteNet:
    """A network fitted to labelled texts by Adam.

    The sample may hold the labels in other shares than the corpus, whose ``sizes`` then move
    the offset by the difference of the log-odds. Without texts of both labels the network says the label it has seen, or 0.5.
    """
    net, draw = ByteNet(seed), np.random.default_rng(seed)
    labels = np.asarray([y for _, y in sample], np.float32)
    if len(set(labels.tolist())) < 2:
        net.weights[:] = 0
        net.offset[:] = {0.0: -6.0, 1.0: 6.0}[labels[0].item()] if len(labels) else 0
        return net
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in net.parameters()]
    step = 0
    for epoch in range(EPOCHS):
        rate = RATE * (1 - epoch / EPOCHS)
        order = draw.permutation(len(sample))
        texts = [sample[i][0] for i in order]
        for part in batches_of(texts, BATCH_BYTES):
            step += 1
            grads = net.gradients(texts[part], labels[order[part]])
            for p, g, (m, v) in zip(net.parameters(), grads, moments):
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                p -= (rate * (m / (1 - 0.9 ** step))
                      / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)).astype(np.float32)
    net.offset += np.log(sizes[1] / sizes[0]) - np.log(labels.sum() / (1 - labels).sum())
    return net


def quality_score(docs: DataFrame, net: ByteNet, text: str = "text") -> Column:
    """A column over ``docs``: the probability of label 1, from 0 to 1, also for null, empty
    and very long texts. Only the text is read."""
    ship_package(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(net)

    def make():
        return lambda texts: pa.array(shared.value.score(texts.to_pylist()), pa.float64())

    return per_array("double", make)(utf8(text))
