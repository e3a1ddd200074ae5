"""The registered queries: each operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeline.llm import (
    alignment,
    ann_tree,
    decontamination,
    folds,
    language_id,
    manifest,
    mixing,
    packing,
    quality_cnn,
    sharding,
    simhash,
    token_counts,
    token_store,
    toxicity_crf,
)
from lakeline.session import scratch_dir

#: Shards of the listing, all of one weight; grown by one.
SHARDS = 16


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "tokens")
    token_store.write_tokens(table(spark, sf_dir, "documents"), path)
    return token_store.token_positions(spark, path).select(
        "doc_id", "start", "n_tokens", "ids_crc32")


def op2_rendezvous_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    listing = sharding.shard_listing(
        table(spark, sf_dir, "documents"), weights=[1.0] * SHARDS, grown=[1.0] * (SHARDS + 1))
    return listing.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard",
                          "slot", "grown_shard")


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    apart = folds.held_out("doc_id", 5, 0)
    model = language_id.train(docs.where(~apart), sample_by=F.col("doc_id"))
    return docs.select("doc_id", apart.alias("held_out"),
                       language_id.predict_language(docs, model).alias("p")).select(
        "doc_id", "held_out", "p.*")


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, apart = table(spark, sf_dir, "documents"), folds.held_out("doc_id", 4, 2)
    net = quality_cnn.train(*folds.labelled_sample(
        docs, table(spark, sf_dir, "labels"), key="doc_id", text="text", label="quality",
        allowed=~apart, rows=quality_cnn.TRAIN_ROWS, max_bytes=quality_cnn.TRAIN_BYTES))
    scored = docs.select("doc_id", apart.alias("held_out"),
                         quality_cnn.quality_score(docs, net).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.7).cast("int"))


def op5_pack_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op6_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann_tree.nearest(table(spark, sf_dir, "embeddings"))


def op7_simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicate_groups(table(spark, sf_dir, "documents"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.contamination_report(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, apart = table(spark, sf_dir, "documents"), folds.held_out("doc_id", 5, 0)
    field = toxicity_crf.train(*folds.labelled_sample(
        docs, table(spark, sf_dir, "labels"), key="doc_id", text="text", label="toxic",
        allowed=~apart, rows=toxicity_crf.TRAIN_ROWS, max_bytes=toxicity_crf.TRAIN_BYTES))
    scored = docs.select("doc_id", apart.alias("held_out"),
                         toxicity_crf.toxicity(docs, field).alias("t"))
    return scored.select("doc_id", "held_out", F.col("t.score").alias("score"),
                         (F.col("t.score") >= 0.5).cast("int").alias("predicted"))


def op11_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken")


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.alignment_report(table(spark, sf_dir, "documents"))


def op13_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    claimed = F.when(tampered, manifest.leaf_hash(
        *(F.col(c) for c in ("doc_id", "source", "lang")), F.col("n_chars") + 1, F.col("text")))
    made = manifest.build(docs, claimed=claimed)
    proof = F.array_join(F.transform("proof", lambda beside: beside["hash"]), "")
    return made.proofs().select(
        F.col("key").alias("doc_id"), F.col("hash").alias("leaf"), "subroot",
        F.lit(made.root).cast("string").alias("root"),
        F.sha2(proof.cast("binary"), 256).alias("proof_sha256"),
        F.col("folded").alias("folded_root"),
        (F.col("folded") == F.lit(made.root)).alias("verified"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_store": op1_token_store,
    "op2_rendezvous_shards": op2_rendezvous_shards,
    "op3_language_id": op3_language_id,
    "op4_quality": op4_quality,
    "op5_pack_sequences": op5_pack_sequences,
    "op6_nearest_neighbours": op6_nearest_neighbours,
    "op7_simhash_groups": op7_simhash_groups,
    "op8_decontamination": op8_decontamination,
    "op9_token_counts": op9_token_counts,
    "op10_toxicity": op10_toxicity,
    "op11_mixing": op11_mixing,
    "op12_alignment": op12_alignment,
    "op13_manifest": op13_manifest,
}
