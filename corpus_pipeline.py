"""From raw documents to packed training sequences: five stages, each a written table.

Each stage takes all that the one before kept and applies one operator of ``lakeline.llm``. All
but the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeline.llm import (
    decontamination,
    folds,
    language_id,
    packing,
    simhash,
    toxicity_crf,
)
from lakeline.llm.arrow import free_name, quoted, stored

#: A document goes if the field finds it toxic with this chance or more.
TOXIC = 0.5
#: A document goes if it has no letters, or its language is less sure than this.
SURE = 0.5


def _kept(docs: DataFrame, made, condition) -> DataFrame:
    """The rows of ``docs`` for which the condition on the made column holds."""
    name = free_name(docs, "__made")
    return docs.withColumn(name, made).where(condition(F.col(name))).select(
        *(quoted(c) for c in docs.columns))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without toxic words. The field is learned from labelled rows of the stage's own
    documents, those of op10's fold; null and empty texts are not toxic and stay."""
    field = toxicity_crf.train(*folds.labelled_sample(
        docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), key="doc_id", text="text",
        label="toxic", allowed=~folds.held_out("doc_id", 5, 0), rows=toxicity_crf.TRAIN_ROWS,
        max_bytes=toxicity_crf.TRAIN_BYTES))
    return _kept(docs, toxicity_crf.toxicity(docs, field), lambda t: t["score"] < TOXIC)


def keep_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the languages that ``lang`` names: not those without a letter (null
    and empty ones too) and not those whose language is unsure."""
    model = language_id.train(docs.where(~folds.held_out("doc_id", 5, 0)),
                              sample_by=F.col("doc_id"))
    return _kept(docs, language_id.predict_language(docs, model),
                 lambda p: (p["lang_pred"] != language_id.UNKNOWN) & (p["score"] >= SURE))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest doc_id."""
    return simhash.one_of_each_group(docs)


def cut_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that benchmark items hold. Passages are cut out and
    n_chars counts what is left; a document of which no word is left goes."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    name = free_name(docs, "__cut")
    cut = docs.withColumn(name, decontamination.without_contamination(docs, items))
    changed = ~F.col(name).eqNullSafe(F.col("text"))
    put = {"text": F.col(name),
           "n_chars": F.when(changed, F.length(name)).otherwise(F.col("n_chars"))}
    columns = [put[c].cast(docs.schema[c].dataType).alias(c) if c in put else quoted(c)
               for c in docs.columns]
    return cut.where(~changed | F.col(name).rlike("[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]")
                     ).select(*columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every piece of every document in sequences of 2048 tokens."""
    return packing.pack_documents(docs)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("language ID", keep_languages),
    ("SimHash near-dedup", drop_near_copies),
    ("benchmark decontamination", cut_benchmark),
    ("best-fit packing", pack),
]

#: The learned stages and the tokenizer can't be put into SQL; tests/llm compares with a
#: brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; what each returns is written and read by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
