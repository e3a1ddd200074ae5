"""Token store, packing and token counts against the tokenizers library."""

import random
import struct
import zlib
from collections import defaultdict

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

tokenizers = pytest.importorskip("tokenizers")
public_tokenizers = pytest.importorskip("public_tokenizers")

from lakeline.llm import packing, token_counts, token_store, tokens  # noqa: E402

PATH = public_tokenizers.path("word_bpe_49k.json")

TEXTS = [
    "", " ", "\n\t\r\x0b\x0c ", "The quick  brown\nfox.", "ÉLÈVE élève Élève Élève é",
    "don't they'll I'm 'S we've", "x1y2 3.14 1,000 $5.00 a-b_c", "Ünï çödé ß ſ ŉ ĳ ﬁ",
    "ΣΑΣ ΟΔΟΣ İstanbul ıI K (kelvin) Å", "<|endoftext|>", "a<|startoftext|>b <|ENDOFTEXT|> <|", "|>",
    "日本語のテキスト 中文，标点。 한국어", "no break wide​zero\u0085next\x1cfs",
    "emoji 👩‍👩‍👧 🇫🇷 ok!!!", "word...,;:!?", "###&&&***", "a" * 3000, "(bracket) [x] {y} \"q\" `c` ~^",
    "́leading mark J̌ ǰ", "tab\tsep|pipe|", "Ǆ ǅ ǆ ǲ", "İ", "q̣̇", "\x00\x01 null",
    "﻿bom �", "UPPER lower MiXeD, CaSe. END",
]


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def description():
    with open(PATH, encoding="utf-8") as f:
        return f.read()


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def crc(ids):
    return zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))


def encoded(model, texts):
    flat, counts = model.encode(pa.array(texts, pa.string()))
    out, at = [], 0
    for n in counts.tolist():
        out.append(flat[at:at + n].tolist())
        at += n
    return out


@pytest.mark.parametrize("cache", [0, 5, 10_000])
def test_encoder_gives_the_ids_of_the_library(library, description, cache, monkeypatch):
    draw = random.Random(5)
    texts = list(TEXTS)
    for _ in range(300):
        texts.append(draw.choice(["", " "]).join(
            draw.choice(draw.choice(TEXTS) or " ") for _ in range(draw.randrange(60))))
    monkeypatch.setattr(tokens, "BLOCK_BYTES", 200)
    model = tokens.WordEncoder(description, cache_words=cache)
    for _ in range(2):
        assert encoded(model, [*texts, None]) == [ids_of(library, t) for t in [*texts, None]]
    assert len(model.known) <= cache


def test_encoder_takes_bytes_that_are_no_text(description):
    raw = pa.array([b"ab \xff\xfe c", b"ok"], pa.binary())
    broken = pa.StringArray.from_buffers(2, raw.buffers()[1], raw.buffers()[2])
    model = tokens.WordEncoder(description)
    flat, counts = model.encode(broken)
    assert counts.sum() == len(flat) and counts[0] > 2


def frame(spark, texts, extra=False):
    rows = [(i // 2 if i % 7 else None, t, i) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens long")
    return df.withColumn("start", F.lit("x")).withColumn("__keep", F.lit(1)) if extra else df


def test_store_round_trip_with_ties_nulls_and_clashing_columns(spark, library, tmp_path):
    texts = [*TEXTS, None, None, "same", "same"]
    path = str(tmp_path / "tokens")
    docs = frame(spark, texts, extra=True)
    token_store.write_tokens(docs.repartition(3), path)
    stored = token_store.read_tokens(spark, path).orderBy("doc_id").collect()
    expected = sorted((str(r.doc_id), [*ids_of(library, r.text), 1]) for r in docs.collect())
    assert sorted((str(r.doc_id), r.ids) for r in stored) == expected
    places = token_store.token_positions(spark, path).collect()
    assert len(places) == len(texts)
    at = 0
    for row in sorted(places, key=lambda r: r.start):
        assert row.start == at
        at += row.n_tokens
    assert [(r.doc_id is not None, r.doc_id) for r in sorted(places, key=lambda r: r.start)] == sorted(
        ((r.doc_id is not None, r.doc_id) for r in places), key=lambda p: (p[0], p[1] or 0))
    assert sorted(r.ids_crc32 for r in places) == sorted(crc(e) for _, e in expected)


def test_store_files_are_ordered_dictionary_coded_and_indexed(spark, tmp_path):
    import glob

    import pyarrow.parquet as pq

    path = str(tmp_path / "tokens")
    docs = spark.range(3000).select(F.col("id").alias("doc_id"),
                                    F.concat_ws(" ", F.lit("the cat"), "id").alias("text"))
    token_store.write_tokens(docs, path)
    last = -1
    for name in sorted(glob.glob(f"{path}/part-*.parquet")):
        table = pq.read_table(name, columns=["doc_id"])
        keys = table["doc_id"].to_pylist()
        assert keys == sorted(keys) and keys[0] > last
        last = keys[-1]
        meta = pq.ParquetFile(name).metadata.row_group(0)
        kinds = {meta.column(i).path_in_schema: meta.column(i) for i in range(meta.num_columns)}
        assert any("DICTIONARY" in e for e in kinds["ids.list.element"].encodings)
        assert "DELTA_BINARY_PACKED" in kinds["doc_id"].encodings
        assert all(c.has_offset_index and c.has_column_index for c in kinds.values())
    plan = token_store.read_tokens(spark, path, ["doc_id"]).where("doc_id = 5")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "ids" not in text.split("ReadSchema")[1].split("\n")[0] and "EqualTo(doc_id,5)" in text


def test_counts_with_nulls_repeats_and_both_tiers(spark, library):
    texts = [*TEXTS, None, "same", "same", "word " * 2049, "word " * 2048]
    docs = frame(spark, texts, extra=True)
    for size in (0, 3, 10_000):
        rows = token_counts.count_tokens(docs, table_words=size).collect()
        expected = sorted((str(r.doc_id), len((r.text or "").encode()), len(ids_of(library, r.text)))
                          for r in docs.collect())
        assert sorted((str(r.doc_id), r.n_bytes, r.n_tokens) for r in rows) == expected
        assert all(r.over_limit == (r.n_tokens > 2048) for r in rows)


def test_frequent_units_cover_all_documents(spark, monkeypatch):
    monkeypatch.setattr(token_counts, "TASK_COUNTED", 4)
    docs = spark.createDataFrame([(i, f"common common rare{i} rare{i}") for i in range(40)],
                                 "doc_id long, text string").repartition(4)
    assert token_counts.frequent_units(docs, "text", 1) == ["common"]


def check_packing(rows, capacity):
    spots = defaultdict(list)
    for r in rows:
        spots[r.sequence_id].append((r.offset, r.length))
    for spot in spots.values():
        at = 0
        for offset, length in sorted(spot):
            assert offset == at
            at += length
        assert at <= capacity
    return len(spots)


def test_packing_pieces_and_places(spark, library):
    texts = [*TEXTS, None, "same", "same", "word " * 70, "word " * 64]
    docs = frame(spark, texts, extra=True)
    packed = packing.pack_documents(docs, capacity=32, with_ids=True).cache()
    rows = packed.collect()
    check_packing(rows, 32)
    expected = []
    for r in docs.collect():
        ids = [*ids_of(library, r.text), 0]
        expected += [(str(r.doc_id), i // 32, i, len(ids[i:i + 32]), crc(ids[i:i + 32]))
                     for i in range(0, len(ids), 32)]
    assert sorted((str(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in rows) == sorted(
        expected)
    for s in packing.sequences(packed).collect():
        mine = sorted((r.offset, bytes(r.ids)) for r in rows if r.sequence_id == s.sequence_id)
        assert bytes(s.ids) == b"".join(i for _, i in mine) and sum(s.lengths) * 4 == len(s.ids)


def best_fit(lengths, capacity):
    """Number of sequences by best fit of single pieces, longest first."""
    gaps = []
    for n in sorted(lengths, reverse=True):
        fit = [g for g in gaps if g >= n]
        if fit:
            gaps.remove(min(fit))
            gaps.append(min(fit) - n)
        else:
            gaps.append(capacity - n)
    return len(gaps)


@pytest.mark.parametrize("seed", range(25))
def test_plan_is_complete_and_as_good_as_best_fit(seed):
    draw = random.Random(seed)
    capacity = draw.choice([7, 30, 100])
    lengths = [min(capacity, 1 + int(draw.expovariate(1 / draw.choice([3, 10, 40]))))
               for _ in range(draw.randrange(1, 400))]
    counts = {n: lengths.count(n) for n in set(lengths)}
    plan = packing.Plan(counts, capacity)
    spots, used = defaultdict(list), dict.fromkeys(counts, 0)
    for length, first, sequence, per, offset in plan.runs:
        assert first == used[length]
        nxt = [f for n, f, *_ in plan.runs if n == length and f > first]
        count = (min(nxt) if nxt else counts[length]) - first
        used[length] += count
        for j in range(count):
            spots[sequence + j // per].append((offset + j % per * length, length))
    assert used == counts and len(spots) == plan.sequences
    big = 0
    for spot in spots.values():
        at = 0
        for offset, length in sorted(spot):
            assert offset == at
            at += length
        assert at <= capacity
        big = max(big, sum(3 * n > capacity for _, n in spot))
    assert big <= 2
    bound = -(-sum(lengths) // capacity)
    assert bound <= plan.sequences <= max(best_fit(lengths, capacity), bound + 1)


def test_lengths_outside_the_capacity_are_refused(spark):
    pieces = spark.createDataFrame([(5,), (0,)], "length long")
    with pytest.raises(ValueError):
        packing.placed(pieces, 10)


def test_one_length_in_many_blocks(spark, monkeypatch):
    pieces = spark.range(1000).select(F.lit(3).cast("long").alias("length"), "id").repartition(5)
    rows = packing.placed(pieces, 10).collect()
    assert check_packing(rows, 10) == 334 and len(rows) == 1000


def test_empty_tables(spark, tmp_path):
    empty = spark.createDataFrame([], "doc_id long, text string")
    token_store.write_tokens(empty, str(tmp_path / "none"))
    assert token_store.token_positions(spark, str(tmp_path / "none")).count() == 0
    assert packing.pack_documents(empty).count() == 0
    assert token_counts.count_tokens(empty).count() == 0
