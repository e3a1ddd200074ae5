"""Slices of Arrow batches, and rows that stay in their order through them."""

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lakeline.llm import arrow


@pytest.mark.parametrize("limit", [1, 5, 1000])
def test_slices_hold_the_limit_or_one_longer_text(limit, monkeypatch):
    monkeypatch.setattr(arrow, "TEXT_BYTES", limit)
    texts = ["", None, "abc", "x" * 20, "é", None, "", "y" * 4]
    for array in (pa.array(texts), pa.array([t.encode() if t is not None else None for t in texts])):
        parts = list(arrow.text_slices(array[1:]))
        assert [i for p in parts for i in range(p.start, p.stop)] == list(range(7))
        for p in parts:
            size = sum(len((t or "").encode()) for t in texts[1:][p])
            assert size <= limit or p.stop - p.start <= 1 or sum(
                bool(t) for t in texts[1:][p]) == 1
    assert list(arrow.text_slices(pa.array([1, 2, 3]))) == [slice(0, 3)]
    assert list(arrow.text_slices(pa.array([], pa.string()))) == []


def test_long_texts_in_one_batch_keep_their_rows(spark):
    long = arrow.TEXT_BYTES // 2 + 1
    df = spark.range(7).select(
        "id", F.when(F.col("id") == 3, None).otherwise(
            F.concat(F.repeat(F.lit("x"), long), F.col("id").cast("string"))).alias("t"),
        F.lit("clash").alias("n")).coalesce(1)
    ends = arrow.per_array("string", lambda: lambda a: pa.array(
        [t[-1:] if t else None for t in a.to_pylist()], pa.string()))
    rows = df.select("id", ends("t").alias("end")).collect()
    assert [(r.id, r.end) for r in rows] == [(i, None if i == 3 else str(i)) for i in range(7)]


def test_free_names_and_odd_column_names(spark):
    df = spark.createDataFrame([(1, "a")], "__made int, `odd.na``me` string")
    assert arrow.free_name(df, "__made") not in df.columns
    assert arrow.free_name(df, "other") == "other"
    assert df.select(arrow.quoted("odd.na`me")).first()[0] == "a"
