"""Language, quality and toxicity: definitions, edge cases and held-out rows."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakeline.llm import folds, language_id, quality_cnn, toxicity_crf

EN = "the of and to in is that for it with was on as are this by from or an be they have which"
DE = "der die und das nicht ist von mit sich auf für eine auch wird zu dem des über können müßte"
FR = "le la les des une est dans pour que qui avec sur pas être élève où ça plus très même"


def prose(draw, words, n):
    return " ".join(draw.choice(words.split()) for _ in range(n)).capitalize() + "."


def test_folds_follow_the_checksum_and_hold_back_null_keys(spark):
    df = spark.createDataFrame([(i,) for i in range(200)] + [(None,)], "doc_id long")
    for r in df.select("doc_id", folds.held_out("doc_id", 5, 0).alias("h")).collect():
        assert r.h == (r.doc_id is None or zlib.crc32(str(r.doc_id).encode()) % 5 == 0)


def test_labelled_sample_is_bounded_and_chosen_by_key(spark):
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(300)] + [(None, "x"), (7, None)],
                                 "doc_id long, text string")
    labels = spark.createDataFrame(
        [(i, i % 3 == 0) for i in range(300)] + [(None, True), (5, None)],
        "doc_id long, bad boolean").select("doc_id", F.col("bad").cast("int").alias("bad"))
    ask = dict(key="doc_id", text="text", label="bad", allowed=F.col("doc_id") < 200)
    sample, sizes = folds.labelled_sample(docs, labels, rows={0: 20, 1: 30},
                                          max_bytes={0: 10_000, 1: 50}, **ask)
    texts = [(int(t.split()[1]), y) for t, y in sample]
    assert all(i < 200 and (i % 3 == 0) == y for i, y in texts) and sizes == {0: 133, 1: 67}
    assert sum(y == 0 for _, y in texts) == 20 and 1 <= sum(y for _, y in texts) < 10
    again, _ = folds.labelled_sample(docs.repartition(5), labels.repartition(3),
                                     rows={0: 20, 1: 30}, max_bytes={0: 10_000, 1: 50}, **ask)
    assert again == sample
    assert folds.labelled_sample(docs, labels.limit(0), rows={0: 1, 1: 1},
                                 max_bytes={0: 1, 1: 1}, **ask) == ([], {})


def test_long_texts_do_not_end_the_sample(spark):
    ids = spark.range(60).select(F.col("id").alias("doc_id"), F.lit(1).alias("bad"))
    by_hash = [r.doc_id for r in ids.orderBy(F.xxhash64("doc_id", F.lit("bad"))).collect()]
    ask = dict(key="doc_id", text="text", label="bad", allowed=F.lit(True), rows={1: 40},
               max_bytes={1: 10_000})
    for place, size in ((0, 20_000), (0, 9_990), (3, 9_990), (3, 20_000)):
        long = by_hash[place]
        docs = spark.createDataFrame([(i, "x" * size if i == long else f"text {i}")
                                      for i in range(60)], "doc_id long, text string")
        sample, _ = folds.labelled_sample(docs, ids, **ask)
        kept = [i for i in by_hash if i != long]
        assert [t for t, _ in sample] == [f"text {i}".encode() for i in kept[:40]]
    # With room for it the long text is in its place, and copies of a row are rows.
    docs = docs.union(docs)
    sample, _ = folds.labelled_sample(docs, ids, **{**ask, "max_bytes": {1: 50_000}})
    assert [len(t) for t, _ in sample[6:8]] == [20_000] * 2 and len(sample) == 40
    length = 20_000 + F.col("doc_id").cast("int")
    huge = docs.where("doc_id > 5").select("doc_id", F.repeat(F.lit("y"), length).alias("text"))
    sample, _ = folds.labelled_sample(huge.distinct(), ids, **ask)
    assert [len(t) for t, _ in sample] == [20_006]


def languages(spark, n):
    draw = random.Random(4)
    rows = [(i, prose(draw, words, draw.randrange(3, 60)), name)
            for i in range(n) for name, words in (("en", EN), ("de", DE), ("fr", FR))]
    rows = [(3 * i + k, t, name) for k, (i, t, name) in enumerate(rows)]
    odd = [(9001, None, "en"), (9002, "", "de"), (9003, "123 !? 4", None), (None, rows[0][1], None),
           rows[0], rows[0], (9005, rows[0][1] * 3000, None)]
    return spark.createDataFrame([*rows, *odd], "doc_id long, text string, lang string")


def test_language_of_held_out_rows_and_odd_ones(spark):
    docs = languages(spark, 120).withColumn("score", F.lit("mine")).repartition(3)
    apart = folds.held_out("doc_id", 5, 0)
    model = language_id.train(docs.where(~apart), sample_by=F.col("doc_id"))
    assert model.languages == ["de", "en", "fr"]
    p = language_id.predict_language(docs, model)
    rows = docs.select("doc_id", "text", "lang", apart.alias("apart"), p.alias("p")).collect()
    known = [r for r in rows if r.apart and r.lang and r.text]
    assert len(known) > 40 and np.mean([r.p.lang_pred == r.lang for r in known]) >= 0.95
    assert all(0 <= r.p.score <= 1 for r in rows)
    by = {r.doc_id: r.p for r in rows}
    assert all((by[i].lang_pred, by[i].score) == ("und", 0) for i in (9001, 9002, 9003))
    assert by[9005].lang_pred == "en"


def test_language_does_not_depend_on_neighbours_or_the_number_of_tasks(spark, monkeypatch):
    docs = languages(spark, 30)
    models = [language_id.train(docs.repartition(n)) for n in (1, 5)]
    assert (models[0].logs == models[1].logs).all()
    texts = [r.text.encode() if r.text is not None else None for r in docs.collect()]
    whole = models[0].predict(texts)
    monkeypatch.setattr(language_id, "BLOCK_BYTES", 1)
    alone = models[0].predict(texts)
    assert whole[0] == alone[0] and np.allclose(whole[1], alone[1])


def test_counts_equal_brute_force():
    texts = [b"Ab c", "É!".encode(), None, b"", b"aaa"]
    buckets, starts, letters = language_id.ngram_buckets(texts)
    assert letters.tolist() == [3, 1, 0, 0, 3] and starts.tolist() == [0, 6, 10, 12, 14]
    grams = (buckets < language_id.BUCKETS).sum(0)
    per_text = [int(x.sum()) for x in np.split(grams, starts[1:])]

    def brute(text):
        line = f" {(text or b'').decode().lower()} "
        line = "".join(c if c.isalpha() else " " for c in line)
        return sum(any(c.isalpha() for c in line[i:i + n]) for n in language_id.ORDERS
                   for i in range(len(line) - n + 1))

    assert per_text == [brute(t) for t in texts]
    same = language_id.ngram_buckets([b"aaa"])[0]
    assert (same == buckets[:, 14:]).all()


def test_language_without_anything_to_learn(spark):
    docs = spark.createDataFrame([(1, "hello", None)], "doc_id long, text string, lang string")
    model = language_id.train(docs)
    row = docs.select(language_id.predict_language(docs, model).alias("p")).first().p
    assert (row.lang_pred, row.score) == ("und", 0)
    assert language_id.train(docs.limit(0)).languages == []


def junk(draw, n):
    return " ".join(draw.choice(EN.split()).upper() + draw.choice(["!!", "###", "$$$"])
                    for _ in range(n))


@pytest.fixture(scope="module")
def net():
    draw = random.Random(2)
    sample = [(prose(draw, EN, draw.randrange(5, 300)).encode(), 1) for _ in range(250)]
    sample += [(junk(draw, draw.randrange(5, 300)).encode(), 0) for _ in range(120)]
    return quality_cnn.train(sample, {0: 120, 1: 250})


def test_quality_of_new_texts(net):
    draw = random.Random(9)
    good = net.score([prose(draw, EN, draw.randrange(10, 400)).encode() for _ in range(60)])
    bad = net.score([junk(draw, draw.randrange(10, 400)).encode() for _ in range(60)])
    assert (good >= 0.7).mean() > 0.95 and (bad < 0.7).mean() > 0.95


def test_quality_scores_whole_texts_alone_and_in_blocks(net, monkeypatch):
    draw = random.Random(8)
    texts = [None, b"", b"a", b"x" * 127, b"x" * 128, b"x" * 129, b"y" * 1000,
             junk(draw, 900).encode(), prose(draw, EN, 2000).encode()]
    whole = net.score(texts)
    assert ((0 <= whole) & (whole <= 1)).all() and whole[0] == whole[1]
    for size in (1, 300, 5000):
        monkeypatch.setattr(quality_cnn, "BLOCK_BYTES", max(size, quality_cnn.HALF))
        assert np.allclose(net.score(texts), whole, atol=1e-6)
    # What stands at the end of a long text counts.
    long = prose(draw, EN, 3000).encode()
    assert net.score([long])[0] > net.score([long + junk(draw, 1500).encode()])[0]


def test_quality_gradients_are_those_of_the_loss():
    net, draw = quality_cnn.ByteNet(3), random.Random(1)
    texts = [draw.randbytes(draw.randrange(1, 900)) for _ in range(6)]
    labels = np.asarray([0, 1, 0, 1, 1, 0], np.float32)

    def loss():
        p = net.score(texts)
        return -np.mean(labels * np.log(p) + (1 - labels) * np.log(1 - p))

    for parameter, gradient in zip(net.parameters(), net.gradients(texts, labels)):
        at = np.unravel_index(np.abs(gradient).argmax(), gradient.shape)
        old, step = parameter[at], 2e-3
        parameter[at] = old + step
        more = loss()
        parameter[at] = old - step
        less = loss()
        parameter[at] = old
        assert abs((more - less) / (2 * step) - gradient[at]) < 0.1 * abs(gradient[at]) + 1e-3


def test_quality_with_one_label_or_none_and_nulls_in_spark(spark):
    assert quality_cnn.train([], {}).score([b"x", None]).tolist() == [0.5, 0.5]
    assert quality_cnn.train([(b"x", 1)], {1: 1}).score([b""])[0] > 0.9
    assert quality_cnn.train([(b"x", 0)], {0: 1}).score([b""])[0] < 0.1
    docs = spark.createDataFrame([(1, None), (None, ""), (2, "a"), (2, "a")],
                                 "doc_id long, text string")
    scores = [r.s for r in docs.select(quality_cnn.quality_score(
        docs, quality_cnn.ByteNet()).alias("s")).collect()]
    assert len(scores) == 4 and scores[0] == scores[1] and scores[2] == scores[3]
    assert docs.limit(0).select(quality_cnn.quality_score(
        docs, quality_cnn.ByteNet()).alias("s")).count() == 0


def test_marginals_equal_step_by_step_sums(monkeypatch):
    draw = np.random.default_rng(0)
    field = toxicity_crf.ToxicityField()
    field.steps, field.start = draw.normal(size=(2, 2)), draw.normal(size=2)
    lengths = np.asarray([1, 5, 63, 64, 65, 128, 300])
    evidence = draw.normal(size=lengths.sum()) * 3
    for lane in (4, 64):
        monkeypatch.setattr(toxicity_crf, "LANE", lane)
        found, at = field.marginals(evidence, lengths), 0
        for n in lengths.tolist():
            odds = [np.asarray([1, np.exp(e)]) for e in evidence[at:at + n]]
            step = np.exp(field.steps)
            ahead = [np.exp(field.start) * odds[0]]
            for o in odds[1:]:
                v = (ahead[-1] @ step) * o
                ahead.append(v / v.sum())
            back = [np.ones(2)]
            for o in odds[:0:-1]:
                v = step @ (back[-1] * o)
                back.append(v / v.sum())
            both = np.asarray([a * b for a, b in zip(ahead, back[::-1])])
            assert np.allclose(both[:, 1] / both.sum(1), found[at:at + n])
            at += n


@pytest.fixture(scope="module")
def field():
    draw = random.Random(5)
    rude = ["idiot", "scum"]
    sample = [(prose(draw, EN, draw.randrange(5, 80)).encode(), 0) for _ in range(400)]
    for _ in range(150):
        words = prose(draw, EN, draw.randrange(5, 80)).split()
        for _ in range(draw.randrange(1, 4)):
            words.insert(draw.randrange(len(words) + 1), draw.choice([*rude, "vile" + draw.choice(
                "ab ba ca da el fo gu hi ji ki".split())]))
        sample.append((" ".join(words).encode(), 1))
    return toxicity_crf.train(sample, {0: 400, 1: 150})


def test_toxic_words_are_found_at_their_places(field):
    draw = random.Random(6)
    text = "É élève, you IDIOT! of and scum idiot the vilexy end"
    scores, spans = field.tag([text.encode(), prose(draw, EN, 200).encode(), b"", None, b"?!"])
    assert scores[0] > 0.9 and scores[1] < 0.5 and scores[2:].tolist() == [0, 0, 0]
    assert [text[a:b] for a, b in spans[0]] == ["IDIOT", "scum idiot", "vilexy"]
    assert spans[1:] == [[], [], [], []]
    long = prose(draw, EN, 30_000) + " scum"
    assert field.tag([long.encode()])[0][0] > 0.5


def test_toxicity_does_not_depend_on_blocks(field, monkeypatch):
    draw = random.Random(7)
    texts = [prose(draw, EN + " scum maybe idiotic", draw.randrange(100)).encode() for _ in range(50)]
    whole, spans = field.tag(texts)
    monkeypatch.setattr(toxicity_crf, "BLOCK_BYTES", 1)
    monkeypatch.setattr(toxicity_crf, "CACHE_WORDS", 0)
    field.known.clear()
    alone, same = field.tag(texts)
    assert np.allclose(whole, alone) and spans == same


def test_copies_are_evidence_once():
    draw = random.Random(8)
    clean = [(prose(draw, EN, 50).encode(), 0) for _ in range(300)]
    copied = [(b"odd words here and " + prose(draw, EN, 50).encode(), 1)] * 100
    assert not toxicity_crf.toxic_marks(clean + copied)


def test_texts_that_share_a_passage_are_no_copies():
    draw = random.Random(6)
    passage = " ".join(f"shared{i}" for i in range(46))
    clean = [(" ".join(f"w{draw.randrange(3000)}" for _ in range(30)).encode(), 0)
             for _ in range(2000)]
    toxic = [(f"{passage} {' '.join(f'w{draw.randrange(3000)}' for _ in range(19))} "
              f"{chr(97 + g) * 3}".encode(), 1) for g in range(10) for _ in range(4)]
    marks = toxicity_crf.toxic_marks(clean + toxic)
    assert {(chr(97 + g) * 3).encode() for g in range(10)} <= marks


def test_segments_are_drawn_from_the_whole_document(monkeypatch):
    learned = []
    monkeypatch.setattr(toxicity_crf, "toxic_marks", lambda sample: {b"bad"})
    monkeypatch.setattr(toxicity_crf, "_fit", lambda field, segments, tags: learned.append(
        [list(s) for s, t in zip(segments, tags) if any(t)]))
    words = [w for i in range(100) for w in ("bad", *[f"p{i}"] * 40)]
    sample = [(" ".join(words).encode(), 1), (b"nothing here", 0)]
    toxicity_crf.train(sample, {0: 1, 1: 1})
    places = [int(w[1:]) for s in learned[0] for w in s if w != b"bad"]
    assert len(learned[0]) == toxicity_crf.TOXIC_SEGMENTS and max(places) >= 80
    again = list(learned[0])
    toxicity_crf.train(sample, {0: 1, 1: 1})
    assert learned[-1] == again


def test_toxicity_with_one_label_or_none_and_nulls_in_spark(spark):
    texts = [b"a b c", b"", None]
    for sizes, expected in (({}, 0), ({0: 3}, 0), ({1: 3}, 1)):
        scores, _ = toxicity_crf.train([], sizes).tag(texts)
        assert abs(scores[0] - expected) < 1e-6 and scores[1:].tolist() == [0, 0]
    lost, _ = toxicity_crf.train([], {0: 3, 1: 3}).tag(texts)
    assert lost[0] < 0.5
    docs = spark.createDataFrame([(1, None), (None, "x"), (2, "a"), (2, "a")],
                                 "doc_id long, text string").withColumn("t", F.lit(1))
    rows = docs.select(toxicity_crf.toxicity(docs, toxicity_crf.ToxicityField(True)).alias("x")).collect()
    assert [(round(r.x.score, 6), [tuple(s) for s in r.x.spans]) for r in rows] == [
        (0, []), (1, [(0, 1)]), (1, [(0, 1)]), (1, [(0, 1)])]
