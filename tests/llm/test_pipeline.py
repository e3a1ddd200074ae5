"""The pipeline and the registered queries of this package."""

import os

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from compare import connect, differences
from lakeline.llm import decontamination, simhash
from lakeline.llm.oracle import ORACLE
from lakeline.llm.queries import QUERIES

SF = os.environ.get("LAKELINE_SF_DIR", "/root/testdata/sf0.001")
needs_tables = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")

EN = ("the of and to in is that for it with was on as are this by from or an be they have which "
      "other were there all when one their more no if out so what up about into than them can")
DE = ("der die und das nicht ist von mit sich auf eine auch wird dem des werden haben noch oder "
      "aber nach wenn nur kann durch ihre diese sind schon immer wieder unter zwischen etwa")


def test_registry_holds_all_operators_and_the_pipeline():
    found = entry.queries()
    assert set(QUERIES) <= set(found) and "pipeline" in found
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(ORACLE) <= set(QUERIES) and set(ORACLE) <= set(entry.oracle_sql())


@needs_tables
@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_sql(spark, name):
    assert differences(QUERIES[name](spark, SF), connect(SF), ORACLE[name]) is None


@needs_tables
@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE) - {"op6_nearest_neighbours"}))
def test_query_returns_every_document(spark, name):
    docs = {r.doc_id for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id").collect()}
    rows = QUERIES[name](spark, SF).collect()
    assert {r.doc_id for r in rows} == docs
    assert len(rows) == len(docs) or name.startswith("op5")


def tables(spark, path, make):
    for name, (rows, schema) in make.items():
        spark.createDataFrame(rows, schema).repartition(2).write.parquet(f"{path}/{name}.parquet")
    return str(path)


KINDS = {"documents": "doc_id long, text string, lang string, source string, n_chars long",
         "labels": "doc_id long, quality int, toxic int", "benchmark": "item_id long, text string"}


def corpus():
    import random

    draw = random.Random(1)

    def prose(words, n):
        return " ".join(draw.choice(words.split()) for _ in range(n))

    docs, labels, toxic = [], [], set()
    for i in range(400):
        words, lang = (EN, "en") if i % 2 else (DE, "de")
        text = prose(words, draw.randrange(20, 90))
        if i % 5 == 0:
            toxic.add(i)
            at = draw.randrange(len(text.split()))
            text = " ".join([*text.split()[:at], "scum", draw.choice(["idiot", "moron"]),
                             *text.split()[at:]])
        docs.append([i, text, lang, "s", len(text)])
        labels.append((i, 1, int(i in toxic)))
    passage = prose("alpha beta gamma delta epsilon zeta eta theta iota kappa", 14)
    leaks = {11, 12}
    for i in leaks:
        docs[i][1] += " " + passage
    copies = {1001: 13, 1002: 13, 1003: 14}
    docs += [[k, docs[v][1], docs[v][2], None, None] for k, v in copies.items()]
    docs += [[2001, None, None, None, None], [2002, "", "en", "s", 0], [2003, "12 !!", None, "s", 5],
             [2004, passage.upper(), "en", "s", 9], [None, docs[16][1], "de", "s", 1]]
    return [tuple(d) for d in docs], labels, toxic, leaks, passage


def test_stages_on_planted_documents(spark, tmp_path):
    docs, labels, toxic, leaks, passage = corpus()
    sf = tables(spark, tmp_path, {"documents": (docs, KINDS["documents"]),
                                  "labels": (labels, KINDS["labels"]),
                                  "benchmark": ([(1, passage), (2, None)], KINDS["benchmark"])})
    now = spark.read.parquet(f"{sf}/documents.parquet")
    kept = []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, now, sf)
        if k < 4:
            assert out.columns == now.columns and out.dtypes == now.dtypes
        out.write.parquet(f"{tmp_path}/stage{k}")
        now = spark.read.parquet(f"{tmp_path}/stage{k}")
        kept.append(now.collect())
    ids = [[r.doc_id for r in rows] for rows in kept]
    clean = {d[0] for d in docs if d[0] is not None} - toxic
    assert not set(ids[0]) & toxic and clean <= set(ids[0]) and None in ids[0]
    assert set(ids[1]) == set(ids[0]) - {2001, 2002, 2003}
    # A passage of Greek letters is in no language the model knows for sure; copies go.
    assert not {1001, 1002, 1003} & set(ids[2]) and None not in ids[2]
    assert set(ids[2]) >= clean - {1001, 1002, 1003, 2001, 2002, 2003, 2004}
    by = {r.doc_id: r for r in kept[3]}
    original = {d[0]: d for d in docs}
    assert 2004 not in by
    for i, r in by.items():
        if i in leaks:
            assert passage not in r.text and r.n_chars == len(r.text)
            assert original[i][1].startswith(r.text.rstrip())
        else:
            assert (r.text, r.n_chars) == (original[i][1], original[i][4])
    assert {r.doc_id for r in kept[4]} == set(by)
    run = corpus_pipeline.run(spark, sf).collect()
    assert sorted((r.doc_id, r.piece, r.length, r.ids_crc32) for r in run) == sorted(
        (r.doc_id, r.piece, r.length, r.ids_crc32) for r in kept[4])


def test_benchmark_stage_searches_each_text_once(spark, tmp_path):
    sf = tables(spark, tmp_path, {n: ([], k) for n, k in KINDS.items()})
    out = corpus_pipeline.cut_benchmark(spark, spark.read.parquet(f"{sf}/documents.parquet"), sf)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1


def test_stages_on_empty_tables(spark, tmp_path):
    sf = tables(spark, tmp_path, {n: ([], k) for n, k in KINDS.items()})
    now = spark.read.parquet(f"{sf}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, now, sf)
        assert out.count() == 0
        now = now if "text" not in out.columns else out
    assert corpus_pipeline.run(spark, sf).count() == 0


@needs_tables
def test_dedup_and_decontamination_stages_equal_the_operators(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    groups = simhash.near_duplicate_groups(docs).where("doc_id = component_id")
    kept = corpus_pipeline.drop_near_copies(spark, docs, SF)
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in groups.collect()}
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    cut = corpus_pipeline.cut_benchmark(spark, docs, SF)
    assert decontamination.contamination_report(cut, items).where("n_hit > 0").count() == 0
    dirty = {r.doc_id for r in decontamination.contamination_report(docs, items)
             .where("n_hit > 0").collect()}
    same = docs.join(cut, ["doc_id", "text", "n_chars"], "left_anti")
    assert {r.doc_id for r in same.collect()} <= dirty
