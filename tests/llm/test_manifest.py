"""Merkle manifest: trees, multiproofs and tampering against a plain recursive version."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from lakeline.llm import manifest, queries

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row):
    doc_id, text, lang, source, n = row
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}"
                       for v in (doc_id, source, lang, n, text)))


def climb(nodes):
    """All levels of a tree, from the leaves to the root."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        now = levels[-1]
        levels.append([sha("".join(now[i:i + 2])) for i in range(0, len(now), 2)])
    return levels


def path(levels, i):
    out = []
    for level in levels[:-1]:
        j = i ^ 1
        out.append((level[j] if j < len(level) else "", i % 2 == 1))
        i //= 2
    return out


def brute(rows):
    by = {}
    for row in rows:
        by.setdefault(row[2], []).append(row)
    langs = sorted(by, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for lang in langs:
        own = sorted(by[lang], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[lang] = own, climb([leaf(r) for r in own])
    crown = climb([trees[x][1][-1][0] for x in langs])
    out = []
    for k, lang in enumerate(langs):
        own, levels = trees[lang]
        for i, row in enumerate(own):
            proof = path(levels, i) + path(crown, k)
            at = leaf(row)
            if row[0] is not None and row[4] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0:
                at = leaf((*row[:4], row[4] + 1))
            for beside, left in proof:
                at = sha(beside + at) if left else sha(at + beside)
            out.append((row[0], leaf(row), levels[-1][0], crown[-1][0],
                        sha("".join(p[0] for p in proof)), at, at == crown[-1][0]))
    return sorted(out, key=str)


def corpus(n):
    rows = [(i, "té\n" * (i % 5), ["en", "de", "fr"][i % 10 % 3], f"s{i}", i) for i in range(n)]
    return rows + [
        (None, None, None, None, None), (None, None, None, None, None), (None, "x", None, "s", 1),
        (3, "again", "en", "s3", 3), (3, "again", "en", "s3", 3), (4, "", "", "", 0),
        (5, "long " * 50_000, "zh", None, 7), (6, None, "en", "s", None), (9, "-", "En", "-", 0)]


def found(spark, rows, tmp_path, **options):
    folder = tmp_path / "sf"
    (spark.createDataFrame(rows, SCHEMA).withColumn("hash", F.lit(1)).withColumn("group", F.lit(2))
     .repartition(3).write.parquet(str(folder / "documents.parquet")))
    return queries.op13_manifest(spark, str(folder))


def test_query_is_brute_force(spark, tmp_path):
    rows = corpus(150)
    got = found(spark, rows, tmp_path)
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(rows)


@pytest.mark.parametrize("levels,n", [(1, 40), (2, 333), (3, 64)])
def test_small_blocks_make_the_same_tree(spark, tmp_path, monkeypatch, levels, n):
    build = manifest.build
    monkeypatch.setattr(manifest, "build", lambda *a, **k: build(*a, **k, levels=levels))
    rows = corpus(n)
    assert sorted((tuple(r) for r in found(spark, rows, tmp_path).collect()), key=str) == brute(rows)


@pytest.mark.parametrize("rows", [[], [(1, "a", "en", "s", 1)],
                                  [(1, "a", "en", "s", 1), (2, "b", "fr", "s", 1)]])
def test_tiny_tables(spark, tmp_path, rows):
    got = sorted((tuple(r) for r in found(spark, rows, tmp_path).collect()), key=str)
    assert got == (brute(rows) if rows else [])


def test_many_groups_and_a_written_manifest(spark, tmp_path):
    rows = [(i, "t", f"lang {i % 90}", "s", 1) for i in range(400)]
    made = manifest.build(spark.createDataFrame(rows, SCHEMA), levels=2)
    assert {made.root} == {r[3] for r in brute(rows)}
    manifest.write_manifest(made, str(tmp_path / "m"))
    again = manifest.read_manifest(spark, str(tmp_path / "m"), levels=2)
    assert again.root == made.root
    assert again.proofs().where(F.col("folded") != made.root).count() == 0


def test_order_of_input_does_not_matter_and_any_change_does(spark):
    rows = corpus(60)
    root = manifest.build(spark.createDataFrame(rows, SCHEMA)).root
    assert manifest.build(spark.createDataFrame(rows[::-1], SCHEMA).repartition(5)).root == root
    assert manifest.build(spark.createDataFrame(rows[1:], SCHEMA)).root != root
    changed = [(*rows[0][:1], "other", *rows[0][2:]), *rows[1:]]
    assert manifest.build(spark.createDataFrame(changed, SCHEMA)).root != root


def test_missing_coordinates_are_enough_and_as_few_as_can_be():
    random.seed(4)
    for leaves in (1, 2, 3, 5, 8, 13, 100):
        levels = climb([sha(str(i)) for i in range(leaves)])
        for _ in range(20):
            known = random.sample(range(leaves), random.randint(1, leaves))
            wanted = manifest.missing_coordinates(known, leaves)
            assert len(set(wanted)) == len(wanted)
            got = {(a, b): levels[a][b] for a, b in wanted}
            own = {i: levels[0][i] for i in known}
            nodes = manifest.derive(own, got, leaves)
            assert nodes[manifest.height(leaves), 0] == levels[-1][0]
            for i in known:
                proof = manifest.proof_of(nodes, i, leaves)
                assert proof == path(levels, i)
                assert manifest.fold(levels[0][i], proof) == levels[-1][0]
            # None can be derived from the known leaves and the others.
            covered = {(0, i) for i in known}
            for a in range(len(levels) - 1):
                covered |= {(a + 1, b // 2) for x, b in covered if x == a}
            assert not covered & set(wanted)
