"""Language of a text: multinomial naive Bayes over hashed character n-grams."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeline.llm.arrow import batches_of, per_array, quoted, ship_package, text_slices, utf8

#: Orders of n-grams, buckets of each order, added to every count.
ORDERS, BUCKETS, SMOOTHING = (1, 2, 3), 1 << 15, 0.5
#: Labelled rows of each language that are learned from, about: a bounded sample by hash.
TRAIN_ROWS = 20_000
#: n-grams that the score takes as independent; longer texts do not get surer than that.
EVIDENCE = 60
BLOCK_BYTES = 500_000
UNKNOWN = "und"

_MULTIPLIERS = np.asarray([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F], np.uint32)
_letters: list[np.ndarray] = []


def letters() -> np.ndarray:
    """Which code points are letters; built once per worker."""
    if not _letters:
        _letters.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
    return _letters[0]


def ngram_buckets(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of the n-grams that begin at each place, the texts' starts, their letters.

    Texts are lower-cased and get a blank before and after; what is no letter is a blank.
    n-grams without a letter, or that reach beyond the text, have the bucket after the last.
    """
    padded = [" " + t.decode("utf-8", "replace").lower() + " " if t else "  " for t in texts]
    starts = np.concatenate([[0], np.cumsum([len(p) for p in padded])])[:-1].astype(np.int64)
    points = np.frombuffer("".join(padded).encode("utf-32-le", "replace"), "<u4")
    letter = letters()[points]
    points = np.where(letter, points, 32).astype(np.uint32)
    n = len(points)
    out = np.empty((len(ORDERS), n), np.int64)
    left = np.append(starts[1:], n)
    # Places from each point to the end of its text.
    room = np.repeat(left, np.diff(np.append(starts, n))) - np.arange(n)
    for row, order in enumerate(ORDERS):
        value = np.zeros(n, np.uint32)
        some = np.zeros(n, bool)
        for i in range(order):
            value[:n - i] += points[i:] * _MULTIPLIERS[i]
            some[:n - i] |= letter[i:]
        value ^= value >> np.uint32(15)
        value *= _MULTIPLIERS[3]
        out[row] = np.where(some & (room >= order),
                            (value >> np.uint32(32 - BUCKETS.bit_length() + 1)), BUCKETS)
    return out, starts, np.add.reduceat(letter, starts) if len(starts) else starts


class LanguageModel:
    """Log-probabilities of the n-grams of every order: rows are buckets, columns languages."""

    def __init__(self, languages: list[str], counts: np.ndarray, rows: np.ndarray):
        self.languages = languages
        smooth = counts + SMOOTHING
        logs = np.log(smooth / smooth.sum(1, keepdims=True))
        # The bucket of n-grams that don't count adds nothing.
        self.logs = np.concatenate([logs, np.zeros_like(logs[:, :1])], 1).astype(np.float32)
        self.prior = np.log((rows + 1) / (rows + 1).sum()) if len(rows) else rows

    def predict(self, texts: list[bytes | None]) -> tuple[list[str], list[float]]:
        names, scores = [], []
        for part in batches_of(texts, BLOCK_BYTES):
            buckets, starts, n_letters = ngram_buckets(texts[part])
            if not self.languages:
                names += [UNKNOWN] * len(starts)
                scores += [0.0] * len(starts)
                continue
            total = np.zeros((len(starts), len(self.languages)))
            for logs, one in zip(self.logs, buckets):
                total += np.add.reduceat(logs[one], starts, axis=0)
            grams = np.add.reduceat((buckets < BUCKETS).sum(0), starts)
            evidence = total * np.minimum(1, EVIDENCE / np.maximum(grams, 1))[:, None] + self.prior
            best = (total + self.prior).argmax(1)
            evidence -= evidence.max(1, keepdims=True)
            chance = np.exp(evidence)
            chance = chance[np.arange(len(best)), best] / chance.sum(1)
            for i, p, known in zip(best.tolist(), chance.tolist(), (n_letters > 0).tolist()):
                names.append(self.languages[i] if known else UNKNOWN)
                scores.append(p if known else 0.0)
        return names, scores


def train(labelled: DataFrame, *, text: str = "text", lang: str = "lang",
          sample_by: Column | None = None, train_rows: int = TRAIN_ROWS) -> LanguageModel:
    """Counts of a sample of about ``train_rows`` rows per language, added up by Spark.

    Rows without a language take no part. Every task adds up its own texts before the shuffle;
    what is collected are buckets times languages. ``sample_by`` is hashed to choose rows, the
    text by default.
    """
    ship_package(labelled.sparkSession)
    named = labelled.where(quoted(lang).isNotNull())
    sizes = {r["lang"]: r["n"] for r in named.groupBy(quoted(lang).cast("string").alias("lang"))
             .agg(F.count("*").alias("n")).collect()}
    languages = sorted(sizes)
    rows = np.asarray([sizes[n] for n in languages], np.float64)
    counts = np.zeros((len(ORDERS), BUCKETS, len(languages)))
    if not languages:
        return LanguageModel(languages, counts, rows)
    share = F.lit(0.0)
    for name in languages:
        share = F.when(quoted(lang) == name, min(1.0, train_rows / sizes[name])).otherwise(share)
    dice = F.pmod(F.xxhash64(quoted(text) if sample_by is None else sample_by), F.lit(1 << 20))
    sample = named.where(dice < share * (1 << 20)).select(
        quoted(lang).cast("string").alias("lang"), utf8(text).alias("text"))
    number = {name: i for i, name in enumerate(languages)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine = np.zeros((len(languages), len(ORDERS), BUCKETS + 1), np.int64)
        for batch in batches:
            names = [number[n] for n in batch.column(0).to_pylist()]
            for part in text_slices(batch.column(1)):
                texts = batch.column(1)[part].to_pylist()
                for inner in batches_of(texts, BLOCK_BYTES):
                    buckets, starts, _ = ngram_buckets(texts[inner])
                    which = np.repeat(names[part][inner],
                                      np.diff(np.append(starts, buckets.shape[1])))
                    for i, row in enumerate(buckets):
                        for k in range(len(languages)):
                            mine[k, i] += np.bincount(row[which == k], minlength=BUCKETS + 1)
        language, order, bucket = np.nonzero(mine[:, :, :BUCKETS])
        yield pa.RecordBatch.from_arrays(
            [pa.array(x) for x in (language, order, bucket, mine[language, order, bucket])],
            ["language", "order", "bucket", "n"])

    kind = "language bigint, order bigint, bucket bigint, n bigint"
    added = sample.mapInArrow(count, kind).groupBy("language", "order", "bucket").agg(
        F.sum("n").alias("n")).toArrow()
    language, order, bucket, n = (c.to_numpy() for c in added.columns)
    counts[order, bucket, language] = n
    return LanguageModel(languages, counts, rows)


def predict_language(docs: DataFrame, model: LanguageModel, text: str = "text") -> Column:
    """A column over ``docs``: struct of lang_pred and score (0 to 1).

    ``und`` and 0 for null texts and texts without a letter, and for all if nothing was learned.
    """
    ship_package(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        def apply(texts: pa.Array) -> pa.Array:
            names, scores = shared.value.predict(texts.to_pylist())
            return pa.StructArray.from_arrays(
                [pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                ["lang_pred", "score"])

        return apply

    return per_array("struct<lang_pred:string,score:double>", make)(utf8(text))
