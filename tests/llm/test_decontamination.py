"""FM-index and contamination against brute force."""

import random
import re
import tracemalloc
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakeline.llm import decontamination as dc
from lakeline.llm.fm_index import FmIndex, WaveletMatrix, suffix_array


@pytest.mark.parametrize("seed", range(30))
def test_index_finds_every_occurrence(seed):
    draw = random.Random(seed)
    size = draw.choice([2, 3, 9, 70])
    text = [draw.randrange(1, size) for _ in range(draw.choice([0, 1, 2, 60, 700]))]
    if seed % 3 == 0:
        text = (text[:20] * 40)[:700]
    whole = np.asarray([*text, 0])
    assert suffix_array(whole).tolist() == sorted(
        range(len(whole)), key=lambda i: whole[i:].tolist())
    index = FmIndex(np.asarray(text, np.int64), size, sample=draw.choice([1, 4, 16]))
    phrases = [[draw.randrange(1, size) for _ in range(draw.randrange(1, 6))] for _ in range(50)]
    rows = np.zeros((50, 5), np.int64)
    for row, phrase in zip(rows, phrases):
        row[:len(phrase)] = phrase
    low, high = index.search(rows, np.asarray([len(p) for p in phrases]))
    for phrase, a, b in zip(phrases, low, high):
        places = [i for i in range(len(text)) if text[i:i + len(phrase)] == phrase]
        assert sorted(index.locate(np.arange(a, max(a, b))).tolist()) == places


def test_wavelet_rank_and_access():
    draw = np.random.default_rng(1)
    symbols = draw.integers(0, 37, 500)
    matrix = WaveletMatrix(symbols, 37)
    found, before = matrix.access(np.arange(500))
    assert (found == symbols).all()
    assert before.tolist() == [int((symbols[:i] == s).sum()) for i, s in enumerate(symbols)]
    at = draw.integers(0, 501, 200)
    ask = draw.integers(0, 37, 200)
    assert matrix.rank(ask, at).tolist() == [int((symbols[:i] == s).sum())
                                             for s, i in zip(ask, at)]


def split(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)


def brute(docs, items, width):
    windows = defaultdict(set)
    for name, text in items:
        words = split(text)
        for i in range(max(len(words) - width, 0) + 1 if words else 0):
            windows[tuple(words[i:i + width])].add("null" if name is None else str(name))
    sizes = {len(w) for w in windows}
    for key, text in docs:
        words, hit, names = split(text), set(), set()
        for n in sizes:
            for i in range(len(words) - n + 1):
                found = windows.get(tuple(words[i:i + n]))
                if found:
                    hit.update(range(i, i + n))
                    names |= found
        spans = []
        for i in sorted(hit):
            if spans and spans[-1][1] == i:
                spans[-1][1] = i + 1
            else:
                spans.append([i, i + 1])
        yield str(key), len(words), len(hit), [tuple(s) for s in spans], sorted(names)


def tables(spark, seed):
    draw = random.Random(seed)
    words = [f"w{i}" for i in range(12)] + ["Éa", "İ9"]
    some = lambda n: [draw.choice(words) for _ in range(n)]
    items = [(i % 9 if i else None, draw.choice([" ", "-", "\n"]).join(some(draw.choice([2, 3, 7, 9]))))
             for i in range(25)]
    items += [(50, None), (51, ""), (52, " ?! "), items[3], (53, items[4][1])]
    docs = []
    for i in range(80):
        body = some(draw.randrange(40))
        for _ in range(draw.randrange(3)):
            at = draw.randrange(len(body) + 1)
            body[at:at] = [w.upper() if w.isascii() else w for w in split(draw.choice(items)[1])]
        docs.append((i if i % 11 else None, draw.choice([", ", " "]).join(body)))
    docs += [(500, None), (501, ""), (502, "..."), docs[1], docs[1], (503, " ".join(some(4000)))]
    return docs, items, spark.createDataFrame(docs, "doc_id long, text string").withColumn(
        "spans", F.lit("mine")), spark.createDataFrame(items, "item_id long, text string")


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("item_bytes", [30, 1_000_000])
def test_report_equals_brute_force(spark, seed, item_bytes, monkeypatch):
    monkeypatch.setattr(dc, "SHARD_BYTES", 500)
    docs, items, d, b = tables(spark, seed)
    found = dc.contamination_report(d.repartition(3), b, width=4, item_bytes=item_bytes).collect()
    assert sorted((str(r.doc_id), r.n_words, r.n_hit, [tuple(s) for s in r.spans], r["items"])
                  for r in found) == sorted(brute(docs, items, 4))


@pytest.mark.parametrize("seed", range(20))
def test_equal_slices_have_one_kind(seed):
    draw = np.random.default_rng(seed)
    values = draw.integers(0, draw.integers(1, 4), draw.integers(1, 200))
    starts = draw.integers(0, len(values) + 1, draw.integers(0, 60))
    lengths = draw.integers(0, len(values) - starts + 1) if len(starts) else starts
    one, kind = dc.equal_slices(values, starts, lengths)
    texts = [tuple(values[a:a + n].tolist()) for a, n in zip(starts, lengths)]
    assert len(one) == len(set(texts))
    assert [texts[one[k]] for k in kind] == texts


def test_a_template_of_many_items_costs_a_text_one_number(spark, monkeypatch):
    """Texts times items would be 12 million pairs here."""
    shared = "this is the one passage that every item of a template holds"
    items = [(f"i{n:04}", f"{shared} and number {n}".encode()) for n in range(3000)]
    texts = [f"{n} {shared} {n}".encode() for n in range(4000)] + [b"", b"clean words"]
    tracemalloc.start()
    phrases = dc.Phrases(items, 10)
    spans, pairs = phrases.find([dc.words_of(t) for t in texts])
    item, counts, of = phrases.items_of(pairs, len(texts))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(pairs) == 4000 and peak < 40_000_000
    assert sorted(counts.tolist()) == [0, 3000] and len(item) == 3000
    assert counts[of].tolist() == [3000] * 4000 + [0, 0]
    monkeypatch.setattr(dc, "LIST_ITEMS", 7000)
    d = spark.createDataFrame([(i, t.decode()) for i, t in enumerate(texts[-50:])], "doc_id int, text string")
    b = spark.createDataFrame([(k, t.decode()) for k, t in items], "item_id string, text string")
    rows = dc.contamination_report(d.coalesce(1), b).orderBy("doc_id").collect()
    names = [k for k, _ in items]
    assert [r["items"] for r in rows] == [names] * 48 + [[], []]
    assert [r.n_hit for r in rows] == [len(shared.split())] * 48 + [0, 0]


@pytest.mark.parametrize("limit", [1, 5, 10_000])
def test_lists_that_overlap_are_joined(limit, monkeypatch):
    monkeypatch.setattr(dc, "LIST_ITEMS", limit)
    items = [("a", b"x y"), ("b", b"x y z"), ("c", b"y z"), ("d", b"z x y")]
    phrases = dc.Phrases(items, 2)
    texts = [b"x y", b"", b"y z", b"x y z", b"z x", b"y x", b"x y", b"z x y z"]
    _, pairs = phrases.find([dc.words_of(t) for t in texts])
    item, counts, of = phrases.items_of(pairs, len(texts))
    ends = np.cumsum(counts)
    got = ["".join(phrases.names[i] for i in item[ends[k] - counts[k]:ends[k]]) for k in of]
    assert got == ["abd", "", "bc", "abcd", "d", "", "abd", "abcd"]


def test_a_text_over_the_shard_is_searched_whole(spark, monkeypatch):
    monkeypatch.setattr(dc, "SHARD_BYTES", 1000)
    draw = random.Random(5)
    body = [draw.choice("abcdefgh") for _ in range(30_000)]
    docs = [(1, " ".join(body)), (2, "x"), (3, " ".join(body[-9:] + ["x"] * 9))]
    items = [(7, " ".join(body[-6:])), (8, " ".join(body[14_000:14_020])), (9, "q r s t u v w x")]
    d = spark.createDataFrame(docs, "doc_id long, text string").coalesce(1)
    b = spark.createDataFrame(items, "item_id long, text string")
    found = dc.contamination_report(d, b, width=6).collect()
    assert sorted((str(r.doc_id), r.n_words, r.n_hit, [tuple(s) for s in r.spans], r["items"])
                  for r in found) == sorted(brute(docs, items, 6))


def test_cut_texts_hold_no_window_and_clean_ones_stay(spark):
    docs, items, d, b = tables(spark, 7)
    cut = d.withColumn("cut", dc.without_contamination(d, b, width=4))
    clean = {k: not hit for k, _, hit, _, _ in brute(docs, items, 4)}
    rows = cut.collect()
    for r in rows:
        if clean[str(r.doc_id)] and r.doc_id is not None:
            assert r.cut == r.text
    assert all(not hit for _, _, hit, _, _ in brute([(r.doc_id, r.cut) for r in rows], items, 4))


@pytest.mark.parametrize("seed", [3, 7])
def test_blocks_of_items_do_not_change_what_is_cut(spark, seed):
    docs, items, d, b = tables(spark, seed)
    join = [(900, "a1 x1 x2 x3 x4 a2 b1 b2 b3 b4"), (901, "x1 x2 b1 b2 b3 b4 x3 x4")]
    more = [(60, "b1 b2 b3 b4"), (61, "x1 x2 x3 x4"), (62, "x4 a2 b1 b2")]
    d = d.select("doc_id", "text").union(spark.createDataFrame(join, "doc_id long, text string"))
    b = b.union(spark.createDataFrame(more, "item_id long, text string")).coalesce(1)
    cut = {n: sorted((str(r.doc_id), str(r.cut)) for r in d.select(
        "doc_id", dc.without_contamination(d, b, width=4, item_bytes=n).alias("cut")).collect())
        for n in (1, 30, 1_000_000)}
    assert cut[1] == cut[1_000_000] and cut[30] == cut[1_000_000]
    assert all(not hit for _, _, hit, _, _ in brute(cut[1], [*items, *more], 4))


def test_cut_keeps_what_is_around_the_words():
    text = "Keep, this! But (cut THESE words) and é keep.".encode()
    words = dc.words_of(text)
    assert words[3:6] == [b"cut", b"these", b"words"]
    assert dc.without_spans(text, [(3, 6)]) == "Keep, this! But () and é keep.".encode()
    assert dc.without_spans(text, []) == text and dc.without_spans(None, [(0, 1)]) is None


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    items = spark.createDataFrame([], "item_id long, text string")
    row = dc.contamination_report(docs, items).first()
    assert (row.n_words, row.n_hit, row.spans, row["items"]) == (2, 0, [], [])
    assert dc.contamination_report(docs.limit(0), items).count() == 0
