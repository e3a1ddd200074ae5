"""Bucketed tables: joins without a shuffle, the same rows, other sessions, hot keys."""

import glob
import json
import re

import pytest
from pyspark.sql import functions as F

from lakeline.operators.joins import hot_keys, left_join
from lakeline.plans.models import run_models
from lakeline.sources.buckets import SPEC, forget_bucketed, read_bucketed, write_bucketed


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def exchanges(df) -> list[str]:
    return re.findall(r"Exchange \w+", df._jdf.queryExecution().executedPlan().toString())


def rows_of(df) -> list[str]:
    return sorted(str(sorted(r.asDict().items())) for r in df.collect())


@pytest.fixture
def sides(spark):
    left = spark.range(400).select(
        F.when(F.col("id") != 7, F.concat(F.lit("k"), "id")).alias("k"), F.col("id").alias("a"))
    right = spark.range(1000).select(
        F.when(F.col("id") % 50 != 0, F.concat(F.lit("k"), F.col("id") % 300)).alias("k"),
        F.col("id").alias("b"))
    return left, right


def test_join_and_grouping_have_no_shuffle(spark, sides, tmp_path, no_broadcast):
    left, right = (write_bucketed(d, f"{tmp_path}/{n}", "k", 5) for n, d in zip("lr", sides))
    joined = left.join(right, "k", "left")
    assert exchanges(joined) == [] and exchanges(sides[0].join(sides[1], "k", "left")) != []
    assert rows_of(joined) == rows_of(sides[0].join(sides[1], "k", "left"))
    assert exchanges(right.groupBy("k").count()) == []
    assert rows_of(right.groupBy("k").count()) == rows_of(sides[1].groupBy("k").count())


def test_a_bucket_is_a_file(spark, sides, tmp_path):
    write_bucketed(sides[1].repartition(20), f"{tmp_path}/r", "k", 3)
    files = glob.glob(f"{tmp_path}/r/*.parquet")
    assert len(files) <= 3 and len({re.search(r"_(\d+)\.c", f).group(1) for f in files}) == len(files)


def test_table_opens_without_its_catalog_entry(spark, sides, tmp_path, no_broadcast):
    for name, side in zip("lr", sides):
        write_bucketed(side, f"{tmp_path}/{name}", "k", 4)
        forget_bucketed(spark, f"{tmp_path}/{name}")
    left, right = (read_bucketed(spark, f"{tmp_path}/{n}") for n in "lr")
    assert exchanges(left.join(right, "k")) == []
    assert rows_of(left.join(right, "k")) == rows_of(sides[0].join(sides[1], "k"))


def test_a_folder_is_written_once_and_only_whole_ones_are_read(spark, sides, tmp_path):
    path = f"{tmp_path}/l"
    write_bucketed(sides[0], path, "k", 2)
    with pytest.raises(ValueError, match="exists"):
        write_bucketed(sides[0], path, "k", 2)
    assert json.load(open(f"{path}/{SPEC}"))["buckets"] == 2
    sides[0].write.parquet(f"{tmp_path}/dead")   # a writer that died before its last step
    with pytest.raises(Exception, match="_bucketing"):
        read_bucketed(spark, f"{tmp_path}/dead")


def test_empty_tables_odd_names_and_other_bucket_numbers(spark, sides, tmp_path, no_broadcast):
    odd = sides[0].select(F.col("k").alias("the `key"), F.struct(F.col("a").alias("x.y")).alias("s"))
    table = write_bucketed(odd, f"{tmp_path}/it's", "the `key", 3)
    forget_bucketed(spark, f"{tmp_path}/it's")
    assert rows_of(read_bucketed(spark, f"{tmp_path}/it's")) == rows_of(odd) == rows_of(table)
    empty = write_bucketed(sides[1].where("false"), f"{tmp_path}/e", "k", 3)
    left = write_bucketed(sides[0], f"{tmp_path}/l5", "k", 5)
    assert left.join(empty, "k", "left").where("b IS NULL").count() == 400


def test_hot_keys_are_sliced_and_the_rest_is_not_shuffled(spark, sides, tmp_path, no_broadcast):
    left, right = sides[0], sides[1].unionAll(
        spark.range(5000).select(F.lit("k3").alias("k"), F.col("id").alias("b")))
    hot = hot_keys(right, "k", slice_rows=2000)
    stored = [write_bucketed(d, f"{tmp_path}/{n}", "k", 4) for n, d in zip("lr", (left, right))]
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    joined = left_join(*stored, "k", hot)
    assert rows_of(joined) == rows_of(left.join(right, "k", "left"))


def test_models_join_staged_tables_in_buckets(spark, rows, no_broadcast):
    raw = {
        "orders": rows.orders(*({"order_id": f"o{i % 9}", "total_vnd": i} for i in range(30))),
        "payments": rows.payments(*({"order_id": f"o{i % 7}", "payment_id": f"p{i % 20}"}
                                    for i in range(40))),
        "rider_events": rows.riders({}),
    }
    plain, bucketed = run_models(spark, raw), run_models(spark, raw, buckets=4)
    assert exchanges(bucketed["int_order_payments"]) == []
    assert exchanges(bucketed["fct_orders"]) == []
    for name in ("int_order_payments", "fct_orders", "rpt_hourly_revenue"):
        assert rows_of(bucketed[name]) == rows_of(plain[name])
