"""Fingerprints, links and groups against brute force."""

import random
import re
from collections import defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from lakeline.llm import components, simhash


def brute_print(text, size=3):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall("[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    runs = [" ".join(words[i:i + size]) for i in range(len(words) - size + 1)] or [" ".join(words)]
    ones = [0] * 64
    for run in runs:
        value = xxhash.xxh64_intdigest(run.encode(), 42)
        for bit in range(64):
            ones[bit] += value >> bit & 1
    return sum(1 << bit for bit in range(64) if 2 * ones[bit] > len(runs))


def brute_groups(prints, distance):
    distinct = sorted(set(prints))
    label = {p: p for p in distinct}

    def top(p):
        while label[p] != p:
            p = label[p]
        return p

    for i, a in enumerate(distinct):
        for b in distinct[i + 1:]:
            if (a ^ b).bit_count() <= distance:
                label[max(top(a), top(b))] = min(top(a), top(b))
    return {p: top(p) for p in distinct}


TEXTS = ["", None, "  \n", "One", "one", "one two", "One two THREE four", "one two three four",
         "É é É", "a b c a b c a b c", "x y z w", "tab\tnew\nline \x0bv", "the " * 500]


def test_prints_equal_the_definition(spark, monkeypatch):
    monkeypatch.setattr(simhash, "BLOCK_SHINGLES", 7)
    raw = [t.encode() if t is not None else None for t in TEXTS]
    for size in (1, 3, 5):
        assert [int(p) for p in simhash.fingerprints(raw, size)] == [
            brute_print(t, size) for t in TEXTS]


def test_spark_hash_is_the_same_one(spark):
    row = spark.sql("select xxhash64('one two three') as h").first()
    assert row.h & (1 << 64) - 1 == xxhash.xxh64_intdigest(b"one two three", 42)


def test_block_counts_follow_from_distances(spark):
    draw = random.Random(1)
    values = [0, -1, 1 << 62, -(1 << 63)] + [draw.getrandbits(63) for _ in range(50)]
    df = spark.createDataFrame([(v,) for v in values], "p long")
    for r in df.select("p", simhash.block_counts(F.col("p")).alias("c")).collect():
        p, counts = r.p & (1 << 64) - 1, r.c & (1 << 64) - 1
        for i in range(32):
            to_reference = (p ^ (3 << 2 * i)).bit_count()
            assert counts >> 2 * i & 3 == (p.bit_count() + 2 - to_reference) // 2


@pytest.mark.parametrize("bucket_rows,batch", [(20_000, 10_000), (5, 7), (1, 3)])
@pytest.mark.parametrize("distance", [0, 1, 2, 3])
def test_dense_groups_equal_brute_force(spark, distance, bucket_rows, batch, monkeypatch):
    """Also where every bucket is crowded, and goes on over many Arrow batches."""
    monkeypatch.setattr(simhash, "BLOCK_PAIRS", 50)
    monkeypatch.setattr(simhash, "BUCKET_ROWS", bucket_rows)
    draw = random.Random(distance)
    prints = set()
    for _ in range(12):
        base = draw.getrandbits(64)
        for _ in range(40):
            one = base
            for _ in range(draw.randrange(5)):
                one ^= 1 << draw.randrange(64)
            prints.add(one)
    prints = sorted(prints)
    label = brute_groups(prints, distance)
    first = {}
    for i, p in enumerate(prints):
        first.setdefault(label[p], i)
    signed = lambda p: p - (1 << 64) if p >> 63 else p
    df = spark.createDataFrame([(i, signed(p)) for i, p in enumerate(prints)], "k long, p long")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        found = simhash.component_of_prints(df.repartition(3), "k", "p", distance).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert {r["print"]: r.component_id for r in found} == {
        signed(p): first[label[p]] for p in prints}


def documents(spark):
    draw = random.Random(3)
    words = [f"w{i}" for i in range(400)]
    rows = [(100 + i, t) for i, t in enumerate(TEXTS)]
    for g in range(6):
        base = [draw.choice(words) for _ in range(300)]
        for c in range(12):
            copy = list(base)
            for _ in range(c // 3):
                copy[draw.randrange(300)] = draw.choice(words)
            rows.append((g * 12 + c, " ".join(copy)))
    rows += [(None, rows[0][1]), (None, rows[20][1]), rows[20], rows[20], (None, "alone here now")]
    return rows, spark.createDataFrame(rows, "doc_id long, text string")


def test_groups_with_nulls_repeats_and_clashing_columns(spark):
    rows, docs = documents(spark)
    label = brute_groups([brute_print(t) for _, t in rows], 2)
    least = defaultdict(list)
    for k, t in rows:
        if k is not None:
            least[label[brute_print(t)]].append(k)
    expected = sorted((str(k), format(brute_print(t), "016x"),
                       str(min(least[label[brute_print(t)]], default=None))) for k, t in rows)
    wide = docs.select("*", F.lit(1).alias("print"), F.lit(2).alias("label"))
    found = simhash.near_duplicate_groups(wide.repartition(3)).collect()
    assert sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in found) == expected


@pytest.mark.parametrize("column", ["row", "_metadata"])
def test_one_row_of_each_group_stays(spark, tmp_path, column):
    rows, docs = documents(spark)
    docs = docs.withColumn(column, F.lit("mine"))
    label = brute_groups([brute_print(t) for _, t in rows], 2)
    groups = defaultdict(list)
    for k, t in rows:
        groups[label[brute_print(t)]].append(k)
    expected = sorted(str(min((k for k in g if k is not None), default=None))
                      for g in groups.values())
    kept = [simhash.one_of_each_group(docs.repartition(3))]
    if column == "row":
        docs.repartition(3).write.parquet(str(tmp_path / "docs"))
        kept.append(simhash.one_of_each_group(spark.read.parquet(str(tmp_path / "docs"))))
    for one in kept:
        assert one.columns == docs.columns
        assert sorted(str(r.doc_id) for r in one.collect()) == expected


def test_components_of_chains_stars_loops_and_repeats(spark):
    edges = [(i, i + 1) for i in range(200)] + [(500, 500 + i) for i in range(1, 300)]
    edges += [(7, 7), (3, 2), (3, 2), (-5, 900)]
    df = spark.createDataFrame(edges, "a long, b long").repartition(3)
    found = {r.node: r.label for r in components.component_labels(df).collect()}
    expected = dict.fromkeys(range(201), 0) | dict.fromkeys(range(500, 800), 500)
    assert found == expected | {-5: -5, 900: -5}


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_duplicate_groups(empty).count() == 0
    assert simhash.one_of_each_group(empty).count() == 0


def test_meeting_masks_leave_one_choice_untouched():
    for distance in (0, 1, 2, 3):
        masks = [m & (1 << 64) - 1 for m in simhash.meeting_masks(distance)]
        for _ in range(200):
            bits = np.random.default_rng(_).choice(64, distance, replace=False)
            assert any(all(not m >> int(b) & 1 for b in bits) for m in masks)
    with pytest.raises(ValueError):
        simhash.meeting_masks(8)


@pytest.mark.parametrize("distance", [0, 1, 2, 3])
def test_bit_masks_leave_one_choice_untouched(distance):
    masks = [m & (1 << 64) - 1 for m in simhash.bit_masks(distance)]
    assert all(m.bit_count() >= 32 for m in masks)
    draw = random.Random(distance)
    for _ in range(200):
        change = 0
        for _ in range(distance):
            change |= 1 << draw.randrange(64)
        assert any(not change & m for m in masks)


def test_a_crowded_bucket_is_split_over_keys(spark, monkeypatch):
    """Near fingerprints of one template: none of the finer buckets is near the size of all."""
    draw, base = random.Random(2), random.Random(1).getrandbits(63)
    prints = {base ^ sum({1 << draw.randrange(63) for _ in range(8)}) for _ in range(20_000)}
    df = spark.createDataFrame([(p,) for p in prints], "print long")
    counts = [df.groupBy(F.col("print").bitwiseAND(F.lit(m))).count().agg(F.max("count")).first()[0]
              for m in simhash.bit_masks(2)]
    assert max(counts) < 200
