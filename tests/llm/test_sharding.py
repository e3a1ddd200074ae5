"""Rendezvous shards: brute force, movement, weights and slots."""

import hashlib
import math
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from lakeline.llm import arrow, sharding


def expected(key, weights):
    def score(i, w):
        name = f"{'null' if key is None else key}:{i}".encode()
        return -math.log((int(hashlib.md5(name).hexdigest()[:13], 16) + 0.5) / 16.0 ** 13) / w

    return min(range(len(weights)), key=lambda i: score(i, weights[i]))


def test_listing_with_ties_nulls_and_clashing_columns(spark):
    rows = [(i % 40 if i % 9 else None, None if i % 5 == 0 else "té" * (i % 3)) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("slot", F.lit("x"))
    found = sharding.shard_listing(docs.repartition(3), weights=[1.0] * 4, grown=[1.0] * 5).collect()
    assert len(found) == len(rows)
    slots = defaultdict(list)
    for r in found:
        assert r.shard == expected(r.doc_id, [1] * 4) and r.grown_shard == expected(r.doc_id, [1] * 5)
        assert r.grown_shard in (r.shard, 4)
        slots[r.shard].append((r.slot, r.doc_id is not None, r.doc_id or 0, r.text_crc32, r["size"]))
    for one in slots.values():
        assert [s[0] for s in sorted(one)] == list(range(len(one)))
        assert [s[1:] for s in sorted(one)] == sorted(s[1:] for s in one)
    assert sorted((str(r.doc_id), r["size"], r.text_crc32) for r in found) == sorted(
        (str(k), len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for k, t in rows)


def test_weights_share_the_keys_and_removal_moves_only_its_own(spark):
    keys = spark.range(20_000).withColumn("shard", F.lit("old"))
    weights = [1.0, 2.0, 3.0, 4.0]
    counts = dict(sharding.assign_shards(keys, key="id", weights=weights).groupBy("shard").count()
                  .collect())
    for i, w in enumerate(weights):
        assert abs(counts[i] / 20_000 - w / 10) < 0.015
    less = sharding.assign_shards(keys, key="id", weights=weights[:3], out="less")
    both = sharding.assign_shards(less, key="id", weights=weights, out="more")
    assert both.where("more < 3 AND more <> less").count() == 0


def test_bad_weights_and_single_shard(spark):
    with pytest.raises(ValueError):
        sharding.best_shard(F.col("id"), [])
    with pytest.raises(ValueError):
        sharding.best_shard(F.col("id"), [1.0, 0.0])
    one = sharding.assign_shards(spark.range(5), key="id", weights=[2.0])
    assert {r.shard for r in one.collect()} == {0}


def test_written_shards_hold_every_row(spark, tmp_path):
    docs = spark.range(100).select(F.col("id").alias("doc_id"), F.lit("x").alias("shard"))
    sharding.write_shards(docs, str(tmp_path / "out"), key="doc_id", weights=[1.0] * 3)
    assert spark.read.parquet(str(tmp_path / "out")).select("doc_id").distinct().count() == 100


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert sharding.shard_listing(empty, weights=[1.0], grown=[1.0, 1.0]).count() == 0


def test_running_total_over_blocks_and_groups(spark):
    rows = spark.range(1000).select("id", (F.col("id") % 3).alias("g"), (F.col("id") % 7).alias("w"))
    table = arrow.stored(rows.repartitionByRange(4, "id").sortWithinPartitions("id"), "totals")
    found = arrow.running_total(table, [F.col("id")], [F.col("g")], F.col("w"), "total", 37).collect()
    sums = defaultdict(int)
    expected_totals = {}
    for i in range(1000):
        expected_totals[i] = sums[i % 3]
        sums[i % 3] += i % 7
    assert {r.id: r.total for r in found} == expected_totals
