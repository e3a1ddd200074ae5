"""Landed feeds and lakes of the registered queries: their size, order and number of files."""

import datetime as dt
import gzip
import json
import os
import re

import pytest
from conftest import utc
from pyspark.sql import DataFrameWriter, Window, functions as F

from lakeline.catalog import queries
from lakeline.session import SHUFFLE_CLEANUP
from lakeline.sources import lake
from lakeline.streaming import writer as writers
from lakeline.streaming.drain import MIN_SPLITS, STATE_VERSIONS, drain, drain_topic, topic_stream
from lakeline.streaming.writer import BatchWriter


def files_of(path):
    return sorted((f"{d}/{n}" for d, _, names in os.walk(path) for n in names
                   if n.startswith("part-")), key=os.path.getmtime)


def lines_of(path):
    with gzip.open(path, "rt") as f:
        return f.read().splitlines()


@pytest.fixture
def orders(rows):
    return rows.orders(*({"order_id": f"o{i}", "event_timestamp": utc("2024-01-05T00:00:00")
                          + dt.timedelta(minutes=i)} for i in range(100))).repartition(3)


def test_landed_lines_are_compressed_in_files_of_bounded_rows(orders, tmp_path):
    queries.land(orders, f"{tmp_path}/l", file_rows=10)
    found = files_of(f"{tmp_path}/l")
    assert all(f.endswith(".json.gz") for f in found)
    assert max(len(lines_of(f)) for f in found) == 10
    assert sum(len(lines_of(f)) for f in found) == 100


def test_ordered_feed_brings_copies_in_the_file_of_their_record(spark, orders, tmp_path):
    number = queries.land_in_order(orders, f"{tmp_path}/l", copies=2)
    found = files_of(f"{tmp_path}/l")
    assert number == len(found) and all(f.endswith(".gz") for f in found)
    at = [r.event_timestamp for f in found for r in spark.read.schema(orders.schema).json(f)
          .select("event_timestamp").distinct().orderBy("event_timestamp").collect()]
    assert at == sorted(at) and len(at) == 100
    assert spark.read.json(f"{tmp_path}/l").groupBy("order_id").count().where(
        "count <> 2").isEmpty()


def test_shuffles_of_a_drain_go_with_their_batch(spark, orders, tmp_path):
    queries.land(orders, f"{tmp_path}/l")
    before, seen = spark.conf.get(SHUFFLE_CLEANUP), []
    stream = spark.readStream.schema(orders.schema).json(f"{tmp_path}/l")
    drain(stream, lambda df, _: seen.append(df.sparkSession.conf.get(SHUFFLE_CLEANUP)),
          f"{tmp_path}/c")
    assert seen and set(seen) == {"true"}
    assert spark.conf.get(SHUFFLE_CLEANUP) == before == "false"


def test_writer_without_files_leaves_rows_where_they_are(spark, orders, tmp_path):
    for name, files in (("plain", None), ("dealt", 4)):
        BatchWriter(f"{tmp_path}/{name}", partition_by=(), files=files)(orders.repartition(9), 0)
    assert len(files_of(f"{tmp_path}/plain")) == 9 and len(files_of(f"{tmp_path}/dealt")) <= 4
    assert spark.read.parquet(f"{tmp_path}/plain").count() == 100


def test_typed_stream_shuffles_nothing(spark, orders, monkeypatch):
    texts = queries._as_text(orders, "placed_at", "event_timestamp")
    monkeypatch.setattr(type(texts), "repartition", None)
    out = queries._typed_stream(spark, texts, "orders", lambda df: df.select("order_id"))
    assert out.distinct().count() == out.count() == 100
    batches = {f.split("batch_id=")[1].split("/")[0] for f in out.inputFiles()}
    assert len(batches) > 1


@pytest.mark.parametrize("file_rows", [10, 200_000])
def test_tasks_of_the_lake_follow_its_rows(spark, orders, monkeypatch, file_rows):
    monkeypatch.setattr(queries, "FILE_ROWS", file_rows)
    monkeypatch.setattr(queries, "LAKE_DAYS", 1)
    monkeypatch.setattr(queries.adapters, "raw_orders", lambda spark, sf_dir: orders)
    base = queries._write_lake(spark, "", files=2)
    found = lake.read_lake(spark, base, orders.schema).groupBy(F.input_file_name()).count().collect()
    assert sum(r["count"] for r in found) == 100
    # One day: two files, or as many as its rows fill.
    assert len(found) > 2 if file_rows == 10 else len(found) <= 2


def test_turns_come_one_after_the_other_in_their_files(spark, tmp_path):
    days = [dt.date(2024, 1, d) for d in (1, 2)]
    lines = spark.range(200).select(
        F.concat(F.lit("line "), F.col("id")).alias("value"),
        F.when(F.col("id") < 120, F.lit(days[0])).when(F.col("id") < 190, F.lit(days[1])).alias("day"))
    turns = [days[0], days[0], days[1], days[1], days[0]]
    queries._land_turns(lines, turns, 3, f"{tmp_path}/l")
    found = files_of(f"{tmp_path}/l")
    assert len(found) == 5 * 3
    for k, day in enumerate(turns):
        of_turn = sorted(x for f in found[3 * k:3 * k + 3] for x in lines_of(f))
        wanted = range(120) if day == days[0] else range(120, 190)
        assert of_turn == sorted(f"line {i}" for i in wanted)


def test_turns_of_nothing(spark, tmp_path):
    lines = spark.range(0).select(F.lit("x").alias("value"), F.lit(None).cast("date").alias("day"))
    queries._land_turns(lines, [], 4, f"{tmp_path}/l")
    assert files_of(f"{tmp_path}/l") == [] or not any(lines_of(f) for f in files_of(f"{tmp_path}/l"))


def test_late_runs_remember_each_key_once(spark, orders, monkeypatch):
    """No record comes twice within a run: one state store, and a feed written at once."""
    seen = []
    monkeypatch.setattr(queries.adapters, "raw_orders", lambda spark, sf_dir: orders)
    monkeypatch.setattr(queries, "drain_topic", lambda *a, **options: seen.append(options) or [])
    base, _ = queries._late_runs(spark, "")
    assert [o["spread"] for o in seen] == [0, 0]
    assert all(f.endswith(".gz") for f in files_of(f"{base}/landing"))
    assert spark.read.option("recursiveFileLookup", "true").json(f"{base}/landing").count() == 200


def test_ordered_feed_computes_its_columns_once(spark, orders, tmp_path):
    """Not a second time for the sample of a range shuffle, nor a line for each copy."""
    made = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(text):
        made.add(1)
        return text

    queries.land_in_order(orders.withColumn("items", counted("items")), f"{tmp_path}/l", copies=3)
    assert made.value == 100
    assert sum(len(lines_of(f)) for f in files_of(f"{tmp_path}/l")) == 300


def test_lines_of_an_ordered_feed_are_those_of_the_json_writer(orders, tmp_path):
    some = orders.withColumn("district", F.when(F.col("order_id") != "o7", F.lit('a "b" ỹ')))
    queries.land_in_order(some, f"{tmp_path}/ordered", copies=2)
    queries.land(some, f"{tmp_path}/plain")
    lines = {name: sorted(x for f in files_of(f"{tmp_path}/{name}") for x in lines_of(f))
             for name in ("ordered", "plain")}
    assert lines["ordered"] == sorted(2 * lines["plain"]) and len(lines["plain"]) == 100


def test_ordered_feed_of_rows_without_a_time_of_one_time_and_of_none(orders, tmp_path):
    at = F.col("event_timestamp")
    some = orders.withColumn("event_timestamp", F.when(F.minute(at) >= 30, at))
    queries.land_in_order(some, f"{tmp_path}/some")
    found = files_of(f"{tmp_path}/some")
    without = [sum("event_timestamp" not in json.loads(x) for x in lines_of(f)) for f in found]
    assert without == [sum(without)] + [0] * (len(found) - 1) and len(found) > 10
    assert sum(without) == 60 and sum(len(lines_of(f)) for f in found) == 100
    for name, rows, number in (("one", some.withColumn("event_timestamp", F.max(at).over(
            Window.partitionBy())), 100), ("none", some.where("false"), 0)):
        queries.land_in_order(rows, f"{tmp_path}/{name}", copies=2)
        assert sum(len(lines_of(f)) for f in files_of(f"{tmp_path}/{name}")) == 2 * number


def test_files_of_a_batch_are_dealt_out_to_all_cores(spark, orders, tmp_path):
    """Twenty small files, four cores: Spark alone packs five into a task."""
    queries.land(orders.repartition(20), f"{tmp_path}/l")
    seen = []

    def look(df):
        # The last shuffle in the lineage is the one that the scan feeds.
        seen.append(int(re.findall(r"\+-\((\d+)\)", df._jdf.rdd().toDebugString())[-1]))
        return df

    drain_topic(spark, "orders", f"{tmp_path}/l", f"{tmp_path}/lake", f"{tmp_path}/c",
                BatchWriter(f"{tmp_path}/lake", transform=look))
    assert seen[0] >= 16
    assert spark.conf.get(MIN_SPLITS, None) is None
    assert lake.read_lake(spark, f"{tmp_path}/lake", orders.schema).count() == 100


def test_own_number_of_scan_tasks_is_kept(spark, orders, tmp_path):
    queries.land(orders, f"{tmp_path}/l")
    spark.conf.set(MIN_SPLITS, "3")
    try:
        drain_topic(spark, "orders", f"{tmp_path}/l", f"{tmp_path}/lake", f"{tmp_path}/c")
        assert spark.conf.get(MIN_SPLITS) == "3"
    finally:
        spark.conf.unset(MIN_SPLITS)


def test_state_of_a_drain_is_kept_in_one_version(spark, orders, tmp_path):
    queries.land(orders, f"{tmp_path}/l")
    before, seen = spark.conf.get(STATE_VERSIONS), []
    writer = BatchWriter(f"{tmp_path}/lake", transform=lambda df: seen.append(
        df.sparkSession.conf.get(STATE_VERSIONS)) or df)
    drain_topic(spark, "orders", f"{tmp_path}/l", f"{tmp_path}/lake", f"{tmp_path}/c", writer)
    assert set(seen) == {"1"} and spark.conf.get(STATE_VERSIONS) == before == "2"


def test_slices_carry_no_path_beside_every_row(spark, orders, tmp_path):
    queries.land(orders, f"{tmp_path}/l")
    plan = topic_stream(spark, "orders", f"{tmp_path}/l")._jdf.queryExecution().analyzed().toString()
    assert "__slice" in plan and "file_path" not in plan


def test_large_batches_are_dealt_out_to_more_tasks_from_the_second_on(
        spark, orders, tmp_path, monkeypatch):
    monkeypatch.setattr(writers, "ROWS_PER_TASK", 5, raising=False)
    writer, found = BatchWriter(f"{tmp_path}/l", partition_by=("city",)), []
    # A stateful batch is not replanned, so its small shuffle tasks are not put together.
    wanted = {"spark.sql.shuffle.partitions": "200", "spark.sql.adaptive.enabled": "false"}
    before = {name: spark.conf.get(name) for name in wanted}
    try:
        for name, value in wanted.items():
            spark.conf.set(name, value)
        for batch in range(2):
            writer(orders, batch)
            found.append(len(files_of(f"{tmp_path}/l/city=hanoi/batch_id={batch}")))
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert found[0] <= 4 < 10 < found[1] <= 20
    assert spark.read.parquet(f"{tmp_path}/l").groupBy("order_id").count().where(
        "count <> 2").isEmpty()


@pytest.mark.parametrize("cities", [3, 30])
def test_partitions_of_a_batch_are_written_without_a_sort(spark, orders, tmp_path, monkeypatch, cities):
    """Or with one, where a task has many of them; the rows are the same."""
    setting, seen, write = "spark.sql.maxConcurrentOutputFileWriters", [], DataFrameWriter.parquet
    some = orders.withColumn("city", F.concat(F.lit("c"), F.minute("event_timestamp") % cities))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda *a: seen.append(
        int(spark.conf.get(setting))) or write(*a))
    try:
        BatchWriter(f"{tmp_path}/l", partition_by=("city",))(some, 0)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    stored = spark.read.schema(some.schema).parquet(f"{tmp_path}/l").select(some.columns)
    assert stored.exceptAll(some).isEmpty() and some.exceptAll(stored).isEmpty()
    assert seen[0] > 0 and spark.conf.get(setting) == "0"
