"""Sketches per hour: errors, merging, repeats, and what a range reads."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from lakeline.operators import sketches
from lakeline.sources.ledger import Ledger

START = dt.datetime(2024, 1, 5, tzinfo=dt.timezone.utc)


@pytest.fixture(scope="module")
def samples(spark):
    """30,000 values over 60 hours, skewed, with many ties and some without a value."""
    i = F.col("id")
    return spark.range(30_000).select(
        (F.lit(START).cast("timestamp") + F.make_dt_interval(secs=i * 7.2)).alias("ts"),
        F.when(i % 3 == 0, "hot").otherwise(F.concat(F.lit("g"), (i % 5).cast("string"))).alias("g"),
        F.when(i % 97 != 0, F.pow(F.pmod(F.xxhash64(i), F.lit(1000)), 2).cast("bigint")).alias("v"),
        F.concat(F.lit("k"), F.pmod(F.xxhash64(i + 1), F.lit(4000)).cast("string")).alias("key"),
    ).persist()


def test_quantiles_of_any_range_have_small_rank_errors(spark, samples, tmp_path):
    path = str(tmp_path / "q")
    for load in range(3):
        part = samples.where(F.pmod(F.hash("key"), F.lit(3)) == load)
        for _ in range(2):
            sketches.store(sketches.quantile_sketches(part, "ts", F.col("v"), ["g"]), path,
                           ("load", load))
    probs = [0.0, 0.1, 0.5, 0.95, 1.0]
    for since, until in ((0, 60), (5, 6), (13, 49)):
        times = [START + dt.timedelta(hours=h) for h in (since, until)]
        rows = samples.where((F.col("ts") >= F.lit(times[0])) & (F.col("ts") < F.lit(times[1])))
        found = sketches.quantiles(sketches.stored_range(spark, path, *times), probs, ["g"])
        errors = {r.g: r for r in sketches.rank_errors(rows, F.col("v"), found, probs, ["g"]).collect()}
        exact = {r.g: r for r in rows.groupBy("g").agg(
            F.count("v").alias("n"), F.min("v").alias("low"), F.max("v").alias("high")).collect()}
        for r in found.collect():
            assert (r.samples, r.low, r.high) == tuple(exact[r.g])[1:]
            assert errors[r.g].samples == r.samples and errors[r.g].worst <= 3 * sketches.RANK_ERROR
            assert list(r.p) == sorted(r.p)
        assert set(errors) == set(exact)


def test_a_sketch_has_a_bounded_size(spark):
    one, many = (spark.range(n).select(F.lit(START).cast("timestamp").alias("ts"), "id")
                 for n in (20_000, 2_000_000))
    sizes = [sketches.quantile_sketches(df, "ts", F.col("id")).select(F.length("sketch")).first()[0]
             for df in (one, many)]
    assert sizes[1] < 40_000 and sizes[1] < 2 * sizes[0]


def test_distinct_counts_do_not_add_up_over_hours(spark, samples, tmp_path):
    path = str(tmp_path / "d")
    sketches.store(sketches.distinct_sketches(samples, "ts", "key", ["g"]), path)
    stored = sketches.stored_range(spark, path, START, START + dt.timedelta(hours=60))
    found = sketches.distinct_counts(stored, ["g"])
    for r in sketches.distinct_errors(samples, "key", found, ["g"]).collect():
        assert r.off <= 4 * sketches.COUNT_ERROR and r.raw_rows > r.final_rows


def test_a_range_opens_folders_of_its_days_only(spark, samples, tmp_path):
    path = str(tmp_path / "q")
    sketches.store(sketches.quantile_sketches(samples, "ts", F.col("v"), ["g"]), path)
    assert len(Ledger(spark, path).latest().parts()) == 3
    since = START + dt.timedelta(hours=26)
    part = sketches.stored_range(spark, path, since, since + dt.timedelta(hours=2))
    assert {f.rsplit("sketch_date=", 1)[1][:10] for f in part.inputFiles()} == {"2024-01-06"}
    assert part.select("hour").distinct().count() == 2


def test_empty_and_null_rows(spark, tmp_path):
    path = str(tmp_path / "q")
    rows = spark.createDataFrame([(None, 1), (START, None)], "ts timestamp, v bigint")
    sketches.store(sketches.quantile_sketches(rows, "ts", F.col("v")), path)
    stored = sketches.stored_range(spark, path, START, START + dt.timedelta(hours=1))
    assert stored.count() == 0 and sketches.quantiles(stored, [0.5]).count() == 0
