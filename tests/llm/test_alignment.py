"""Alignment of two tokenizers against the libraries on whole texts and brute force."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakeline.llm import alignment

SCHEMA = "doc_id long, text string"
NAMES = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.fixture(scope="module")
def libraries():
    import sentencepiece
    from tokenizers import Tokenizer

    a, b = alignment.default_tokenizers()
    first = Tokenizer.from_file(a)
    first.encode_special_tokens = True
    return first, sentencepiece.SentencePieceProcessor(model_file=b)


def tokens(libraries, text):
    """(ids, bytes) of both for a whole text, or nothing."""
    a, b = libraries
    if not text:
        return None
    letters = {c: v for v, c in alignment.byte_letters().items()}
    first = [(i, bytes(letters[c] for c in a.id_to_token(i)))
             for i in a.encode(" " + text, add_special_tokens=False).ids]
    second = [(i, bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i)
               else b.id_to_piece(i).replace("▁", " ").encode()) for i in b.encode(text)]
    whole = (" " + text).encode()
    if b"".join(t for _, t in first) != whole or b"".join(t for _, t in second) != whole:
        return None
    return first, second


def spans(side):
    out, at = [], 0
    for i, t in side:
        out.append((at, at + len(t), i))
        at += len(t)
    return out


def brute(libraries, rows):
    held, counts = [], Counter()
    for key, text in rows:
        both = tokens(libraries, text)
        if both is None:
            held.append((key, None))
            continue
        a, b = map(spans, both)
        links = [(x[2], y[2]) for x in a for y in b if x[0] < y[1] and y[0] < x[1]]
        counts.update(set(links))
        held.append((key, (a, b, links)))
    most = defaultdict(int)
    for (a, _), n in counts.items():
        most[a] = max(most[a], n)
    out = []
    for key, got in held:
        if got is None:
            out.append((key, 0, 0, 0, 0, 0, 0, ""))
            continue
        a, b, links = got
        cuts = sorted({x[1] for x in a} & {y[1] for y in b})
        said = []
        for lo, hi in zip([0, *cuts], cuts):
            said.append("|".join(",".join(str(t[2]) for t in side if lo <= t[0] and t[1] <= hi)
                                 for side in (a, b)))
        out.append((key, len(a), len(b), len(cuts), len(links),
                    sum(counts[x] == most[x[0]] for x in links), sum(counts[x] for x in links),
                    hashlib.sha256(";".join(said).encode()).hexdigest()))
    return sorted(out, key=str)


TEXTS = [
    "The cat sat on the mat.", "the cat's hat, isn't it?", "", None, " ", "  two  blanks ",
    "line\nnext line\n\n new", "tab\tand hard blank", "naïve café Élève über straße", "日本語のテキスト and more",
    "emoji 🙂🙃 end", "a ▁ piece mark", "<s> special <|endoftext|> </s> <0x41> <unk>",
    "digits 12345 3.14 x1y2", "under_score 'quoted' (brackets) [x] {y}", "é combining",
    "​zero‍width", "ends with blank ", " begins with blank", "\x00nul \x1f unit",
    "trailing'", "word'. word'). it's", "a \n b", "　wide", "ﬁ ligature", "...", "-", "x" * 3000,
    "word " * 2000, "The cat sat on the mat.", "﻿bom", "ſ long s Å", "tonè x", "İ İ",
]
ROWS = [(i, t) for i, t in enumerate(TEXTS)] + [(None, "null key"), (0, TEXTS[0])]


@pytest.mark.parametrize("table", [1 << 20, 40, 0])
def test_report_is_brute_force(spark, libraries, table):
    docs = (spark.createDataFrame(ROWS, SCHEMA).withColumn("a", F.lit("x"))
            .withColumn("place", F.lit(1)).repartition(3))
    got = alignment.alignment_report(docs, table_links=table)
    assert got.columns == NAMES
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(libraries, ROWS)


def test_words_alone_have_the_ids_of_whole_texts(spark, libraries):
    a, b = libraries
    rows = alignment.token_groups(
        spark.createDataFrame(list(enumerate(TEXTS)), SCHEMA)).collect()
    for r in rows:
        both = tokens(libraries, TEXTS[r.doc_id])
        assert (r.a, r.b) == (([], []) if both is None else tuple(
            [i for i, _ in side] for side in both)), TEXTS[r.doc_id]


def test_given_documents_match_the_libraries(spark, libraries):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in docs.where(F.length("text") < 2500).collect()]
    got = alignment.alignment_report(spark.createDataFrame(rows, SCHEMA))
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(libraries, rows)


def test_slices_and_partial_counts_change_nothing(spark, monkeypatch):
    docs = spark.createDataFrame(ROWS, SCHEMA).coalesce(1)
    whole = sorted(map(str, alignment.alignment_report(docs).collect()))
    from pyspark import cloudpickle

    # Workers get this module by value, with the small limits.
    cloudpickle.register_pickle_by_value(alignment)
    monkeypatch.setattr(alignment, "SLICE_TOKENS", 30)
    monkeypatch.setattr(alignment, "COUNTED_LINKS", 50)
    try:
        assert sorted(map(str, alignment.alignment_report(docs).collect())) == whole
    finally:
        cloudpickle.unregister_pickle_by_value(alignment)


def test_groups_are_what_pointers_lead_to():
    rng = np.random.default_rng(1)
    for _ in range(200):
        n = int(rng.integers(1, 40))
        a_cuts, b_cuts = (np.append(np.flatnonzero(rng.random(n - 1) < p) + 1, n)
                          for p in rng.random(2))
        a, b = (np.diff(c, prepend=0) for c in (a_cuts, b_cuts))
        found = alignment.align(a, b, np.asarray([len(a)]))
        ends = sorted(set(a_cuts.tolist()) & set(b_cuts.tolist()))
        assert found.a_group.tolist() == [np.searchsorted(ends, e) for e in a_cuts]
        assert found.b_group.tolist() == [np.searchsorted(ends, e) for e in b_cuts]
        assert found.group_ends.tolist() == [len(ends)]
        spans_a, spans_b = (list(zip(c - s, c)) for c, s in ((a_cuts, a), (b_cuts, b)))
        assert list(zip(found.a_link, found.b_link)) == [
            (i, j) for i, x in enumerate(spans_a) for j, y in enumerate(spans_b)
            if x[0] < y[1] and y[0] < x[1]]


def test_token_groups_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "The cat's hat"), (2, None)], SCHEMA)
    rows = {r.doc_id: r for r in alignment.token_groups(docs).collect()}
    assert rows[2].a == rows[2].b_group == []
    assert len(rows[1].a) == len(rows[1].a_group) and len(rows[1].b) == len(rows[1].b_group)
    assert set(rows[1].a_group) == set(rows[1].b_group) == set(range(rows[1].a_group[-1] + 1))
    empty = spark.createDataFrame([], SCHEMA)
    assert alignment.alignment_report(empty).collect() == []
