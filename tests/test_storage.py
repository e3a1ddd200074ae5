"""Loads, sinks, upserts, compaction and swaps."""

import datetime as dt
import json
import os

import pytest
from conftest import dicts
from pyspark.sql import functions as F, types as T

from lakeline.functions import with_event_date_parts
from lakeline.operators import merge
from lakeline.operators.compaction import compact
from lakeline.plans import incremental
from lakeline.plans.models import run_models
from lakeline.schemas import ORDERS
from lakeline.sources import lake, landing, swap, tables
from lakeline.sources.fs import Folder
from lakeline.sources.ledger import Ledger, read_table

D = dt.date


def fact(spark, *rows):
    return spark.createDataFrame(rows, "order_id string, placed_date date, city string, v int")


def stored(spark, path, *columns):
    df = read_table(spark, path)
    return sorted(tuple(r) for r in df.select(*(columns or ("order_id", "placed_date", "v")))
                  .collect())


def upsert(spark, path, df, **options):
    return merge.upsert(spark, path, df, "order_id", "placed_date", ["city"], **options)


def test_upsert_replaces_inserts_and_moves(spark, tmp_path):
    path = str(tmp_path / "fct")
    upsert(spark, path, fact(spark, ("a", D(2024, 1, 1), "x", 1), ("b", D(2024, 1, 2), "x", 1),
                             ("c", D(2024, 1, 2), "x", 1), ("d", D(2024, 1, 9), "x", 1)))
    untouched = [f for f in Ledger(spark, path).latest().of() if f.part.endswith("-09")]
    changes = fact(spark, ("a", D(2024, 1, 3), "x", 2), ("b", D(2024, 1, 2), "x", 2),
                   ("e", D(2024, 1, 4), "x", 2))
    expected = [("a", D(2024, 1, 3), 2), ("b", D(2024, 1, 2), 2), ("c", D(2024, 1, 2), 1),
                ("d", D(2024, 1, 9), 1), ("e", D(2024, 1, 4), 2)]
    for _ in range(2):
        rewritten = upsert(spark, path, changes)
        assert stored(spark, path) == expected
    assert "2024-01-09" not in rewritten
    now = Ledger(spark, path).latest()
    assert "placed_date=2024-01-01" not in now.parts()
    assert [f for f in now.of() if f.part.endswith("-09")] == untouched


def test_first_load_is_written_once(spark, tmp_path, monkeypatch):
    asked, real = [], merge.scratch_dir
    monkeypatch.setattr(merge, "scratch_dir", lambda *a: asked.append(a) or real(*a))
    path, days = str(tmp_path / "t"), ("2024-01-01", "2024-01-02")
    df = spark.createDataFrame([("a", 1, days[0]), ("b", 2, days[1]), ("b", 3, days[1])],
                               "k string, v int, day string")
    assert merge.upsert(spark, path, df, "k", "day") == [*days] and asked == []
    live = Ledger(spark, path).latest().of()
    assert [(f.part, f.rows, f.low, f.high) for f in live] == [
        (f"day={days[0]}", 1, "a", "a"), (f"day={days[1]}", 2, "b", "b")]
    assert sorted(map(tuple, read_table(spark, path, df.schema).collect())) == sorted(
        map(tuple, df.collect()))


def test_first_load_that_comes_second_is_an_upsert(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    one, two = (spark.createDataFrame([(k, v, "2024-01-01")], "k string, v int, day string")
                for k, v in (("a", 1), ("a", 2)))
    real, calls = Ledger.stage, []

    def stage(self, *args, **options):
        calls.append(1)
        if len(calls) == 1:
            merge.upsert(spark, path, one, "k", "day")
        return real(self, *args, **options)

    monkeypatch.setattr(Ledger, "stage", stage)
    merge.upsert(spark, path, two, "k", "day")
    assert [tuple(r) for r in read_table(spark, path, two.schema).collect()] == [
        ("a", 2, "2024-01-01")]


def test_upsert_of_nothing_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "fct")
    first = fact(spark, ("a", D(2024, 1, 1), "x", 1))
    upsert(spark, path, first)
    assert upsert(spark, path, first.limit(0)) == []
    assert stored(spark, path) == [("a", D(2024, 1, 1), 1)]


def test_upsert_adds_columns_only_when_allowed(spark, tmp_path):
    path = str(tmp_path / "fct")
    upsert(spark, path, fact(spark, ("a", D(2024, 1, 1), "x", 1), ("b", D(2024, 1, 2), "x", 1)))
    wide = fact(spark, ("b", D(2024, 1, 2), "x", 2)).withColumn("note", F.lit("new"))
    with pytest.raises(ValueError, match="note"):
        upsert(spark, path, wide, evolve=False)
    upsert(spark, path, wide)
    got = merge.read_table(spark, path, wide.schema).select("order_id", "v", "note").collect()
    assert sorted(map(tuple, got)) == [("a", 1, None), ("b", 2, "new")]
    # A later source without the column keeps it.
    upsert(spark, path, fact(spark, ("c", D(2024, 1, 2), "x", 3)))
    got = merge.read_table(spark, path, wide.schema).select("order_id", "note").collect()
    assert sorted(map(tuple, got), key=str) == [("a", None), ("b", "new"), ("c", None)]


def test_incremental_bound(spark):
    at = dt.datetime(2024, 1, 5, 12)
    source = spark.createDataFrame(
        [(m, at - dt.timedelta(minutes=m)) for m in (0, 10, 11)], "m int, ts timestamp_ntz")
    target = source.where("m = 0")
    kept = merge.incremental_source(source, target, "ts").collect()
    assert sorted(r.m for r in kept) == [0, 10]
    assert merge.incremental_source(source, target.limit(0), "ts").count() == 3
    assert merge.incremental_source(source, None, "ts").count() == 3


def at(minute):
    return dt.datetime(2024, 1, 5, 3, minute, tzinfo=dt.timezone.utc)


def test_incremental_run_equals_the_filtered_full_model(spark, rows, tmp_path):
    orders = rows.orders(
        {"order_id": "old", "placed_at": at(0)},
        {"order_id": "edge", "placed_at": at(20)},
        # The newest version of this order was placed before the bound.
        {"order_id": "back", "placed_at": at(29), "event_timestamp": at(29)},
        {"order_id": "back", "placed_at": at(1), "event_timestamp": at(40)},
        {"order_id": "new", "placed_at": at(30)},
    )
    payments = rows.payments(
        {"payment_id": "p1", "order_id": "new", "event_timestamp": at(31), "status": "failed"},
        {"payment_id": "p1", "order_id": "new", "event_timestamp": at(32)},
        # First booked on a recent order, then moved away.
        {"payment_id": "p2", "order_id": "edge", "event_timestamp": at(31)},
        {"payment_id": "p2", "order_id": "old", "event_timestamp": at(33)},
    )
    raw = {"orders": orders, "payments": payments, "rider_events": rows.riders({})}
    full = run_models(spark, raw)["fct_orders"]
    since = dt.datetime(2024, 1, 5, 10, 20)
    part = incremental.incremental_fct_orders(
        spark, orders, payments, since, str(tmp_path / "scratch"))
    expected = full.where(F.col("placed_at_local") >= F.lit(since).cast("timestamp_ntz"))
    assert sorted(map(str, part.collect())) == sorted(map(str, expected.collect()))
    assert sorted(r.order_id for r in part.collect()) == ["edge", "new"]


def test_run_incremental_leaves_stale_rows_to_a_full_refresh(spark, rows, tmp_path):
    path = str(tmp_path / "fct")
    first = rows.orders({"order_id": "stale", "placed_at": at(0)},
                        {"order_id": "recent", "placed_at": at(11)})
    none = rows.payments({"order_id": "other"})
    incremental.run_incremental(spark, first, none, path)
    assert incremental.run_incremental(spark, first, none, path, max_move_days=1) == ["2024-01-05"]
    later = first.unionByName(rows.orders(
        {"order_id": "stale", "placed_at": at(0), "event_timestamp": at(50), "status": "delivered"},
        {"order_id": "recent", "placed_at": at(11), "event_timestamp": at(50),
         "status": "delivered"}))
    incremental.run_incremental(spark, later, none, path)
    got = dict(stored(spark, path, "order_id", "order_status"))
    assert got == {"stale": "placed", "recent": "delivered"}
    raw = {"orders": later, "payments": none, "rider_events": rows.riders({})}
    upsert(spark, path, run_models(spark, raw)["fct_orders"])
    assert dict(stored(spark, path, "order_id", "order_status"))["stale"] == "delivered"


# --- loads ----------------------------------------------------------------

def landed(tmp_path, *lines):
    folder = landing.landing_day(str(tmp_path), "orders", "2024-01-05")
    os.makedirs(folder)
    with open(f"{folder}/batch_1_ab.jsonl", "w") as f:
        f.writelines(x + "\n" for x in lines)
    return f"{tmp_path}/orders"


def order_line(order_id, **more):
    base = {f.name: "x" for f in ORDERS if f.dataType.typeName() == "string"}
    base |= {f.name: 1 for f in ORDERS if f.dataType.typeName() == "long"}
    base |= {"placed_at": "2024-01-05T03:00:00Z", "event_timestamp": "2024-01-05T03:00:00Z"}
    return json.dumps({**base, "order_id": order_id, **more})


def test_load_day_appends_or_replaces(spark, tmp_path):
    topic, table = landed(tmp_path, order_line("a"), order_line("b", unknown=1)), \
        f"{tmp_path}/raw"
    load = lambda **o: landing.load_day(spark, topic, table, ORDERS, "2024-01-05", **o)
    assert load() == 2 and load() == 2
    assert landing.read_raw(spark, table, ORDERS).count() == 4
    assert load(mode="replace_day") == 2
    raw = landing.read_raw(spark, table, ORDERS)
    assert raw.count() == 2 and raw.columns == ORDERS.names


def test_load_of_a_day_without_files(spark, tmp_path):
    topic = landed(tmp_path, order_line("a"))
    assert landing.load_day(spark, topic, f"{tmp_path}/raw", ORDERS, "2024-01-06") == 0
    assert Ledger(spark, f"{tmp_path}/raw").versions() == []


def test_rejected_load_leaves_nothing_behind(spark, tmp_path):
    topic, table = landed(tmp_path, order_line("a"), "{bad"), f"{tmp_path}/raw"
    with pytest.raises(landing.TooManyBadRecords):
        landing.load_day(spark, topic, table, ORDERS, "2024-01-05")
    assert Ledger(spark, table).versions() == []
    assert landing.load_day(spark, topic, table, ORDERS, "2024-01-05", max_bad=1) == 1


# --- sinks, layout, compaction --------------------------------------------

def test_rerun_of_a_day_replaces_it_also_with_nothing(spark, tmp_path):
    base = str(tmp_path / "daily")
    df = spark.range(3)
    for _ in range(2):
        lake.overwrite_partition(df, base, "date", "2024-01-05")
        lake.overwrite_partition(df, base, "date", "2024-01-06")
    assert read_table(spark, base).count() == 6
    lake.overwrite_partition(df.limit(0), base, "date", "2024-01-05")
    assert [str(r.date) for r in read_table(spark, base).collect()] == ["2024-01-06"] * 3


def write_lake(spark, rows, base, files, batches=(0,)):
    df = with_event_date_parts(rows.orders(*[{"order_id": f"o{i}"} for i in range(50)]))
    for b in batches:
        df.withColumn("batch_id", F.lit(b).cast("bigint")).repartition(files).write.mode(
            "append").partitionBy(*lake.DAY_COLUMNS, "batch_id").parquet(base)


def test_compaction_keeps_rows_and_lowers_files(spark, rows, tmp_path):
    base = str(tmp_path / "lake")
    write_lake(spark, rows, base, 10, batches=(0, 1))
    before = sorted(map(str, lake.read_lake(spark, base, ORDERS).collect()))
    done = compact(spark, base, "2024-01-05")
    assert (done.rows, done.skipped) == (100, None)
    assert done.files_after == 1 < done.files_before
    assert sorted(map(str, lake.read_lake(spark, base, ORDERS).collect())) == before
    assert compact(spark, base, "2024-01-05").skipped == "already_compact"
    write_lake(spark, rows, base, 4, batches=(2,))
    assert compact(spark, base, "2024-01-05").rows == 150


def test_compaction_skips(spark, rows, tmp_path):
    base = str(tmp_path / "lake")
    write_lake(spark, rows, base, 2)
    assert compact(spark, base, "2024-01-06").skipped == "no_data"
    empty = f"{base}/year=2024/month=1/day=7/batch_id=0"
    spark.createDataFrame([], ORDERS).write.parquet(empty)
    assert compact(spark, base, "2024-01-07").skipped == "empty"


def test_compaction_of_a_lake_without_batches(spark, rows, tmp_path):
    base = str(tmp_path / "lake")
    df = with_event_date_parts(rows.orders(*[{"order_id": f"o{i}"} for i in range(20)]))
    df.repartition(5).write.partitionBy(*lake.DAY_COLUMNS).parquet(base)
    assert compact(spark, base, "2024-01-05").files_after == 1
    assert lake.read_lake(spark, base, ORDERS).count() == 20


def test_compaction_size_sets_the_file_count(spark, rows, tmp_path):
    base = str(tmp_path / "lake")
    write_lake(spark, rows, base, 10)
    size, files = Folder(spark, base).child("year=2024/month=1/day=5").size()
    done = compact(spark, base, "2024-01-05", target_bytes=size // 3)
    assert 1 < done.files_after <= 4 < files


class Stopped(RuntimeError):
    pass


def stop_at(monkeypatch, call):
    """The ``call``-th move or deletion of a folder, and all after it, do not happen."""
    done = iter(range(1000))

    def guarded(real):
        def act(self, *args):
            if next(done) >= call:
                raise Stopped
            return real(self, *args)
        return act

    for name in ("move_to", "delete"):
        monkeypatch.setattr(Folder, name, guarded(getattr(Folder, name)))


@pytest.mark.parametrize("call", range(6))
def test_compaction_of_nested_days_is_whole_after_a_crash_at_any_step(
        spark, rows, tmp_path, monkeypatch, call):
    base = str(tmp_path / "lake")
    for day in (4, 5, 6):
        at = dt.datetime(2024, 1, day, 3, tzinfo=dt.timezone.utc)
        df = with_event_date_parts(rows.orders(*[
            {"order_id": f"{day}-{i}", "placed_at": at} for i in range(20)]))
        df.withColumn("batch_id", F.lit(0).cast("bigint")).repartition(4).write.mode(
            "append").partitionBy(*lake.DAY_COLUMNS, "batch_id").parquet(base)
    with monkeypatch.context() as m:
        stop_at(m, call)
        try:
            compact(spark, base, "2024-01-05")
        except Stopped:
            pass
    # The driver died and the next run begins, perhaps to die again at its first deletion.
    with monkeypatch.context() as m:
        stop_at(m, 1)
        try:
            swap.recover(spark, base)
        except Stopped:
            pass
    swap.recover(spark, base)
    read = lake.read_lake(spark, base, ORDERS)
    assert sorted(r.order_id for r in read.collect()) == sorted(
        f"{d}-{i}" for d in (4, 5, 6) for i in range(20))
    compact(spark, base, "2024-01-05")
    assert lake.read_lake(spark, base, ORDERS).count() == 60
    assert Folder(spark, f"{base}/_swap").names() == []


def test_swap_of_several_partitions_goes_on_where_it_stopped(spark, tmp_path):
    base = str(tmp_path / "t")
    spark.range(6).withColumn("a", F.col("id") % 2).withColumn("b", F.col("id") % 3).write.partitionBy(
        "a", "b").parquet(base)
    for step in range(12):
        work, table = swap.open_swap(spark, base), Folder(spark, base)
        spark.range(10, 12).write.parquet(work.child("new/a=0/b=0").path)
        spark.range(20, 21).write.parquet(work.child("new/a=7/b=0").path)
        with pytest.MonkeyPatch.context() as m:
            stop_at(m, step)
            try:
                swap.commit(work, table, ["a=0/b=0", "a=1/b=1", "a=7/b=0"])
            except Stopped:
                pass
        committed = step > 0
        swap.recover(spark, base)
        found = {(r.a, r.b, r.id) for r in spark.read.parquet(base).collect()}
        assert found == ({(0, 2, 2), (1, 0, 3), (0, 1, 4), (1, 2, 5), (0, 0, 10), (0, 0, 11),
                          (7, 0, 20)} if committed else
                         {(0, 0, 0), (1, 1, 1), (0, 2, 2), (1, 0, 3), (0, 1, 4), (1, 2, 5)})


def test_tolerated_bad_records_are_kept(spark, tmp_path):
    import os

    schema = T.StructType([T.StructField("id", T.LongType(), False)])
    source = landing.landing_day(str(tmp_path), "topic", "2024-01-05")
    os.makedirs(source)
    with open(f"{source}/a.json", "w") as f:
        f.write('{"id": 1}\n{"id": "x"}\n{broken\n')
    with pytest.raises(landing.TooManyBadRecords):
        landing.load_day(spark, f"{tmp_path}/topic", f"{tmp_path}/raw", schema, "2024-01-05",
                         max_bad=1)
    assert Ledger(spark, f"{tmp_path}/raw").versions() == []
    assert landing.load_day(spark, f"{tmp_path}/topic", f"{tmp_path}/raw", schema, "2024-01-05",
                            max_bad=2) == 1
    bad = landing.read_quarantine(spark, f"{tmp_path}/raw").collect()
    assert sorted(r.reason for r in bad) == ["unreadable", "unreadable"]
    # A reload replaces them together with the rows.
    landing.load_day(spark, f"{tmp_path}/topic", f"{tmp_path}/raw", schema, "2024-01-05",
                     "replace_day", max_bad=2)
    assert landing.read_quarantine(spark, f"{tmp_path}/raw").count() == 2


def test_compaction_of_one_large_file_among_many_tiny_ones(spark, tmp_path):
    base = str(tmp_path / "lake")
    day = f"{base}/year=2024/month=1/day=5"
    big = spark.range(200_000).select(F.col("id"), F.xxhash64("id").alias("x"))
    big.coalesce(1).write.parquet(day)
    spark.range(30).select(F.col("id"), F.col("id").alias("x")).repartition(10).write.mode(
        "append").parquet(day)
    size = sum(os.path.getsize(f"{day}/{n}") for n in os.listdir(day) if n.endswith(".parquet"))
    done = compact(spark, base, "2024-01-05", target_bytes=size // 12)
    assert done.skipped is None and done.rows == 200_030


def test_materialize(spark, tmp_path):
    df = fact(spark, ("a", D(2024, 1, 1), "x", 1), ("b", D(2024, 1, 2), "y", 2))
    assert tables.materialize(df, "view", name="v1") is df
    assert spark.table("v1").count() == 2
    for _ in range(2):
        out = tables.materialize(df, "table", str(tmp_path / "t"), ["placed_date"], ["city"])
    assert out.columns == df.columns and out.count() == 2
    with pytest.raises(ValueError):
        tables.materialize(df, "other")
    stats = {r["placed_date"]: r for r in dicts(
        tables.table_stats(spark, str(tmp_path / "t"), ["placed_date"]))}
    assert stats[D(2024, 1, 1)]["total_rows"] == 1 and stats[D(2024, 1, 1)]["bytes"] > 0
