"""Streams: dedup strengths, late rows, restart, replay, quarantine, speed layer."""

import datetime as dt
import json
import os

import pytest
from conftest import dicts, utc
from pyspark.sql import functions as F

from lakeline.schemas import ORDERS, required
from lakeline.sources import lake, landing, typed
from lakeline.streaming import hourly
from lakeline.streaming.dedup import dedup_stream
from lakeline.streaming.drain import (
    drain, drain_quarantine, drain_topic, ingest_topic, topic_stream,
)
from lakeline.streaming.metrics import batch_rows, read_batches, read_runs, store_run
from lakeline.streaming.writer import BatchWriter, TooManySkips

START = utc("2024-01-05T03:00:00")


def line(order_id="o1", seconds=0, **more):
    at = (START + dt.timedelta(seconds=seconds)).isoformat().replace("+00:00", "Z")
    base = {f.name: "x" for f in ORDERS if f.dataType.typeName() == "string"}
    base |= {f.name: 100 for f in ORDERS if f.dataType.typeName() == "long"}
    base |= {"placed_at": at, "event_timestamp": at, "producer_ts": 1.0, "order_id": order_id}
    return {**base, **more}


class Landing:
    def __init__(self, spark, base):
        self.spark, self.base, self.files = spark, str(base), 0

    def put(self, *lines):
        """One landed file; file times follow arrival order."""
        folder = f"{self.base}/landing/year=2024/month=01/day=05"
        os.makedirs(folder, exist_ok=True)
        self.files += 1
        path = f"{folder}/batch_{self.files:04d}.jsonl"
        with open(path, "w") as f:
            f.writelines((x if isinstance(x, str) else json.dumps(x)) + "\n" for x in lines)
        os.utime(path, (1_700_000_000 + self.files,) * 2)
        return path

    def drain(self, **options):
        return drain_topic(self.spark, "orders", f"{self.base}/landing", f"{self.base}/lake",
                           f"{self.base}/checkpoint", **options)

    def lake(self):
        found = lake.read_lake(self.spark, f"{self.base}/lake", ORDERS).collect()
        return sorted((r.order_id, r.event_timestamp.minute * 60 + r.event_timestamp.second)
                      for r in found)


@pytest.fixture
def land(spark, tmp_path):
    return Landing(spark, tmp_path)


def test_stream_keeps_each_id_and_time_once(land):
    land.put(line(), line(), line(seconds=1), line("o2"))
    land.drain()
    assert land.lake() == [("o1", 0), ("o1", 1), ("o2", 0)]


def test_stronger_form_keeps_one_row_per_id(land):
    land.put(line(), line(seconds=1), line("o2"))
    land.drain(within_watermark=True)
    assert [i for i, _ in land.lake()] == ["o1", "o2"]


def test_spread_dedup_gives_the_same_rows(land):
    land.put(*[line(f"o{i % 7}", i % 3) for i in range(200)])
    land.put(*[line(f"o{i % 7}", i % 3) for i in range(200)])
    land.drain(spread=4)
    assert land.lake() == sorted({(f"o{i % 7}", i % 3) for i in range(200)})


def test_late_row_of_a_later_run_is_dropped_and_counted(land, spark):
    land.put(line("o1", 3000))
    first = land.drain()
    land.put(line("late", 3000 - 1800), line("fresh", 3000 - 300))
    second = land.drain()
    assert [i for i, _ in land.lake()] == ["fresh", "o1"]
    late = batch_rows(spark, "stream-orders", first + second).agg(F.sum("late_rows"))
    assert late.first()[0] == 1


def test_restart_resumes_without_loss_or_repetition(land):
    land.put(line("o1"), line("o2"))
    land.drain()
    assert land.drain() == [] or land.lake() == [("o1", 0), ("o2", 0)]
    land.put(line("o1"), line("o3"))
    land.drain()
    assert land.lake() == [("o1", 0), ("o2", 0), ("o3", 0)]


def test_many_small_batches_equal_one_batch(land, spark, tmp_path):
    rows = [line(f"o{i % 9}", i % 4) for i in range(40)]
    for i in range(0, 40, 5):
        land.put(*rows[i:i + 5])
    assert len(land.drain(max_files=1)) >= 8
    whole = Landing(spark, tmp_path / "whole")
    whole.put(*rows)
    whole.drain()
    assert land.lake() == whole.lake()


def test_limit_in_bytes_holds_whatever_the_files(land):
    small, large = [line(f"o{i}") for i in range(40)], [line(f"p{i}") for i in range(30)]
    sizes = [os.path.getsize(land.put(x)) for x in small] + [os.path.getsize(land.put(*large))]
    limit = sum(sizes[:10]) + 10
    rows = [b["input_rows"] for b in land.drain(max_bytes=limit) if b["input_rows"]]
    # Ten small files a batch; the large one is over the limit and comes alone.
    assert rows == [10, 10, 10, 10, 30]
    assert len(land.lake()) == 70


def test_lake_day_is_the_utc_day_of_the_event(land, spark):
    land.put(line(seconds=-3 * 3600 - 1), line("o2"))
    land.drain(delay="1 day")
    base = f"{land.base}/lake"
    assert lake.read_day(spark, base, "2024-01-04", ORDERS).count() == 1
    assert lake.read_day(spark, base, "2024-01-05", ORDERS).count() == 1
    assert lake.read_day(spark, base, "2024-01-06", ORDERS).count() == 0
    assert lake.read_day(spark, f"{base}-none", "2024-01-06", ORDERS).count() == 0


def test_replayed_batch_overwrites_itself(spark, rows, tmp_path):
    from lakeline.functions import with_event_date_parts

    writer = BatchWriter(str(tmp_path / "lake"))
    batch = with_event_date_parts(rows.orders({}, {"order_id": "o2"}))
    writer(batch, 0)
    writer(batch, 0)
    writer(with_event_date_parts(rows.orders({"order_id": "o3"})), 1)
    assert lake.read_lake(spark, str(tmp_path / "lake"), ORDERS).count() == 3
    assert [b["rows"] for b in writer.batches] == [2, 2, 1]
    assert all(b["rows_per_sec"] > 0 for b in writer.batches)


def test_empty_batch_writes_nothing(spark, rows, tmp_path):
    from lakeline.functions import with_event_date_parts

    writer = BatchWriter(str(tmp_path / "lake"))
    writer(with_event_date_parts(rows.orders({}).limit(0)), 0)
    assert writer.batches == []
    assert [f for f in os.listdir(tmp_path / "lake") if not f.startswith(("_", "."))] == []


def test_vanished_input_fails_or_is_skipped(spark, rows, tmp_path):
    source = str(tmp_path / "source")

    def vanished():
        rows.orders({}).write.mode("overwrite").parquet(source)
        df = spark.read.parquet(source)
        for name in os.listdir(source):
            if name.endswith(".parquet"):
                os.remove(f"{source}/{name}")
        return df

    with pytest.raises(Exception, match="FILE_NOT_EXIST|FileNotFound|does not exist"):
        BatchWriter(str(tmp_path / "a"), partition_by=())(vanished(), 0)
    writer = BatchWriter(str(tmp_path / "b"), partition_by=(), on_missing="skip", max_skips=2)
    writer(vanished(), 0)
    writer(vanished(), 1)
    assert writer.skips == 2 and writer.batches == []
    with pytest.raises(TooManySkips):
        writer(vanished(), 2)
    for skips in (writer.skips, 0):
        store_run(spark, str(tmp_path / "metrics"), "stream-orders", [], skips=skips)
    runs = dicts(read_runs(spark, str(tmp_path / "metrics")))
    assert sorted(r["skipped_batches"] for r in runs) == [0, 3]


def test_other_failures_are_no_missing_input(spark, rows, tmp_path):
    writer = BatchWriter(str(tmp_path / "c"), partition_by=(), on_missing="skip")
    named = rows.orders({}).withColumn(
        "city", F.raise_error(F.lit("FILE_NOT_EXIST FileNotFoundException")).cast("string"))
    with pytest.raises(Exception, match="FILE_NOT_EXIST"):
        writer(named, 0)
    assert writer.skips == 0


def test_every_landed_line_is_accounted_for_over_many_batches(land, spark):
    """More batches than Spark keeps progress of, with late, repeated and broken lines."""
    kept = spark.conf.get("spark.sql.streaming.numRecentProgressUpdates")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "10")
    try:
        for i in range(40):
            land.put(line(f"o{i}", 60 * i), line(f"o{i}", 60 * i), "{broken",
                     *([line(f"late{i}", 60 * i - 3600)] if i > 30 else []))
        base = land.base
        run = ingest_topic(spark, "orders", f"{base}/landing", f"{base}/lake", f"{base}/checkpoint",
                           f"{base}/bad", f"{base}/metrics", max_files=1)
    finally:
        spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", kept)
    assert (run["input_rows"], run["stored_rows"], run["duplicate_rows"], run["late_rows"],
            run["quarantined_rows"]) == (129, 40, 40, 9, 40)
    assert lake.read_lake(spark, f"{base}/lake", ORDERS).count() == 40
    assert spark.read.parquet(f"{base}/bad").count() == 40
    batches = read_batches(spark, f"{base}/metrics")
    assert batches.count() == run["batches"] >= 40
    assert batches.agg(F.sum("input_rows")).first()[0] == 129
    land.put("{broken again")
    with pytest.raises(landing.TooManyBadRecords):
        ingest_topic(spark, "orders", f"{base}/landing", f"{base}/lake", f"{base}/checkpoint",
                     f"{base}/bad", f"{base}/metrics", max_bad=0)
    assert read_runs(spark, f"{base}/metrics").count() == 2
    assert spark.read.parquet(f"{base}/bad").count() == 41


@pytest.mark.parametrize("files", [1, 5, 100])
def test_rows_do_not_depend_on_the_number_of_batches(land, files):
    rows = [line(f"o{i % 20}", 30 * (i // 2)) for i in range(60)]
    for i in range(0, 60, 4):
        land.put(*rows[i:i + 4])
    land.drain(max_files=files)
    assert land.lake() == sorted({(r["order_id"], 30 * (i // 2)) for i, r in enumerate(rows)})


def test_files_of_a_drain_do_not_follow_the_shuffle(land, spark):
    """Two hundred shuffle tasks, fourteen days: a few files per day, and one day reads alone."""
    land.put(*[line(f"o{i}", 86_400 * (i % 14) + i) for i in range(2_000)])
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "200")
    try:
        land.drain(spread=0)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    found = [f"{d}/{n}" for d, _, names in os.walk(f"{land.base}/lake") for n in names
             if n.endswith(".parquet")]
    assert 14 <= len(found) <= 4 * 14
    day = lake.read_day(spark, f"{land.base}/lake", "2024-01-06", ORDERS)
    assert len(day.inputFiles()) <= 4 and day.count() == 143
    assert {(r.year, r.month, r.day) for r in day.select("year", "month", "day").collect()} == {
        (2024, 1, 6)}


def test_broken_records_go_to_quarantine(land, spark):
    land.put(line("good"), "{not json", line("null_city", city=None),
             line("typed", total_vnd="abc"))
    land.drain()
    assert land.lake() == [("good", 0)]
    drain_quarantine(spark, "orders", f"{land.base}/landing", f"{land.base}/bad",
                     f"{land.base}/checkpoint-bad")
    bad = dicts(spark.read.parquet(f"{land.base}/bad"))
    assert sorted(b["reason"] for b in bad) == ["missing city", "unreadable", "unreadable"]
    assert all(b["record"] for b in bad)
    assert any("{not json" in b["record"] for b in bad)


def test_bad_record_threshold(spark, tmp_path):
    path = str(tmp_path / "x.json")
    with open(path, "w") as f:
        f.writelines("{bad\n" for _ in range(11))
    df = spark.read.schema(landing.with_corrupt_column(ORDERS)).json(path)
    _, bad = landing.split_corrupt(df, required(ORDERS))
    assert landing.assert_max_bad(bad, 11) == 11
    with pytest.raises(landing.TooManyBadRecords):
        landing.assert_max_bad(bad, 10)


def test_unknown_fields_are_dropped(land, spark):
    land.put(line(extra="ignored"))
    land.drain()
    assert "extra" not in lake.read_lake(spark, f"{land.base}/lake", ORDERS).columns


def test_hourly_sums_count_duplicates(land, spark):
    land.put(line(), line(), line("o2", 3600, status="cancelled"))
    stream, _ = landing.split_corrupt(
        landing.read_events(spark, f"{land.base}/landing", ORDERS), ["order_id"])
    for name, run, read in (
        ("totals", hourly.drain_hourly_totals, hourly.read_hourly_totals),
        ("partials", hourly.drain_hourly_partials, hourly.read_hourly_partials),
    ):
        path, checkpoint = f"{land.base}/{name}", f"{land.base}/checkpoint-{name}"
        run(stream, path, checkpoint)
        first = sorted((r.hour.hour, r.total_orders, r.cancelled_orders)
                       for r in read(spark, path).collect())
        assert first == [(3, 2, 0), (4, 1, 1)]
    land.put(line("o3"))
    for name, run, read in (
        ("totals", hourly.drain_hourly_totals, hourly.read_hourly_totals),
        ("partials", hourly.drain_hourly_partials, hourly.read_hourly_partials),
    ):
        path, checkpoint = f"{land.base}/{name}", f"{land.base}/checkpoint-{name}"
        run(stream, path, checkpoint)
        again = {r.hour.hour: r.total_revenue_vnd for r in read(spark, path).collect()}
        assert again == {3: 300, 4: 100}


def test_typed_ingest_of_text_rows(spark, rows):
    uid = "0F8FAD5B-D9CB-469F-A165-70867728950E"
    text = rows.riders({"event_id": uid, "rider_id": uid, "order_id": ""}).withColumn(
        "event_timestamp", F.lit("2024-01-05T03:00:00.123456Z"))
    out = dicts(typed.typed_rider_events(text))[0]
    assert out["order_id"] is None and out["event_id"] == uid.lower()
    assert out["event_timestamp"].microsecond == 123000 and out["_ingested_at"]
    undated = text.withColumn("event_timestamp", F.lit("yesterday"))
    with pytest.raises(Exception, match="not a time"):
        typed.typed_rider_events(undated).collect()
    _, bad = landing.split_corrupt(typed.typed_rider_events(undated, strict=False),
                                   ["event_timestamp"])
    assert [r.reason for r in bad.collect()] == ["missing event_timestamp"]
    broken = text.withColumn("rider_id", F.lit("nope"))
    with pytest.raises(Exception, match="not a UUID"):
        typed.typed_rider_events(broken).collect()
    lenient = typed.typed_rider_events(broken.unionByName(text), strict=False)
    good, bad = landing.split_corrupt(lenient, ["event_id", "rider_id", "event_timestamp"])
    assert good.count() == 1
    assert [r.reason for r in bad.collect()] == ["missing rider_id"]


def test_row_number_is_refused_on_streams_but_dedup_is_not(spark, land):
    from lakeline.operators.dedup import latest_by

    land.put(line())
    stream = topic_stream(spark, "orders", f"{land.base}/landing")
    with pytest.raises(Exception, match="(?i)window"):
        drain(latest_by(stream, ["order_id"], "event_timestamp"),
              BatchWriter(f"{land.base}/no", partition_by=()), f"{land.base}/c1")
    good, _ = landing.split_corrupt(
        landing.read_events(spark, f"{land.base}/landing", ORDERS), ["order_id"])
    drain(dedup_stream(good, "order_id"), BatchWriter(f"{land.base}/yes", partition_by=()),
          f"{land.base}/c2")
    assert spark.read.parquet(f"{land.base}/yes").count() == 1


# --- levelled sums --------------------------------------------------------

def hours(spark, *rows):
    return spark.createDataFrame(
        [(c, START + dt.timedelta(hours=h), v, s) for c, h, v, s in rows],
        "city string, placed_at timestamp, total_vnd bigint, status string")


def sums_of(spark, path):
    return sorted(map(tuple, hourly.read_hourly_levels(spark, path).collect()))


def test_levels_bound_what_a_reader_opens(spark, tmp_path):
    path, batches = str(tmp_path / "sums"), 21
    sums = hourly.LevelledSums(spark, path, fan=3)
    for b in range(batches):
        sums(hours(spark, ("hanoi", b % 4, 10 * b, "placed"), ("hue", 0, 1, "cancelled")), b)
    levels = [f.part for f in sums.table.latest().of()]
    # 21 batches, three by three: 21 = 2 * 9 + 1 * 3 + 0 * 1
    assert sorted(levels) == ["level=1", "level=2", "level=2"]
    assert sums_of(spark, path) == sorted(
        [("hue", START.replace(tzinfo=None), batches, batches, batches)]
        + [("hanoi", (START + dt.timedelta(hours=h)).replace(tzinfo=None),
            len(range(h, batches, 4)), sum(10 * b for b in range(h, batches, 4)), 0)
           for h in range(4)])


@pytest.mark.parametrize("call", range(1, 7))
def test_levels_survive_a_crash_at_any_commit(spark, tmp_path, monkeypatch, call):
    from lakeline.sources import ledger

    class Stopped(RuntimeError):
        pass

    path, done = str(tmp_path / "sums"), iter(range(100))
    real = ledger.publish

    def publish(*args):
        if next(done) >= call:
            raise Stopped
        return real(*args)

    def run():
        sums = hourly.LevelledSums(spark, path, fan=2)
        for b in range(4):
            sums(hours(spark, ("hanoi", 0, 10 ** b, "placed")), b)

    with monkeypatch.context() as m:
        m.setattr(ledger, "publish", publish)
        try:
            run()
        except Stopped:
            pass
    run()  # every batch comes again
    assert [r[2:] for r in sums_of(spark, path)] == [(4, 1111, 0)]
    assert len(ledger.Ledger(spark, path).latest().of()) == 1


def test_an_empty_batch_and_a_merge_by_someone_else(spark, tmp_path, monkeypatch):
    from lakeline.sources.ledger import Ledger

    path = str(tmp_path / "sums")
    sums = hourly.LevelledSums(spark, path, fan=2)
    sums(hours(spark).limit(0), 0)
    sums(hours(spark, ("hue", 0, 5, "placed")), 1)
    real, first = Ledger.exchange, [True]

    def late(self, *args):
        if first.pop() if first else False:
            hourly.LevelledSums(spark, path, fan=2).merge()
        return real(self, *args)

    monkeypatch.setattr(Ledger, "exchange", late)
    sums(hours(spark, ("hue", 0, 6, "placed")), 2)
    assert [r[2:] for r in sums_of(spark, path)] == [(2, 11, 0)]
    with pytest.raises(ValueError):
        hourly.LevelledSums(spark, path, fan=1)
