"""Stored check results against checks of the whole table."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from lakeline.operators import check_state, quality
from lakeline.operators.merge import upsert
from lakeline.sources import ledger
from lakeline.sources.ledger import Ledger, read_table


def checks():
    return [quality.not_null_check("v"), quality.Check("small", "v", F.col("v") > 5)]


SCHEMA = "id string, day date, v int"


def rows(spark, *data):
    return spark.createDataFrame([(i, dt.date(2024, 1, d), v) for i, d, v in data], SCHEMA)


def add(spark, path, *data):
    table, df = Ledger(spark, path), rows(spark, *data)
    table.add(table.stage(df, ("day",), key="id"), df.schema, ("day",))


def full(spark, path):
    return sorted(map(tuple, quality.keyed_checks(read_table(spark, path), "id", checks()).collect()))


def kept(spark, state):
    return sorted(map(tuple, check_state.check_report(spark, state, "id").collect()))


@pytest.fixture
def run(spark, tmp_path):
    path, state = str(tmp_path / "t"), str(tmp_path / "s")

    def go():
        looked = check_state.check_changes(spark, path, state, "id", checks())
        assert kept(spark, state) == full(spark, path)
        return {p[-2:] for p in looked}

    return path, state, go


def test_results_follow_every_change(spark, run):
    path, state, go = run
    add(spark, path, ("a", 1, 1), ("a", 1, 2), ("b", 1, None), ("c", 2, 9), (None, 2, 1), (None, 2, 1))
    assert go() == {"01", "02"}
    assert go() == set()
    # A key of another day comes again, and a day is added to.
    add(spark, path, ("b", 3, 7), ("d", 3, 1))
    assert go() == {"03"}
    add(spark, path, ("c", 1, 1), ("d", 1, 1))
    assert go() == {"01"}
    # The copies go: keys are unique again though other days did not change.
    Ledger(spark, path).replace_parts(rows(spark, ("z", 1, 1)), ("day",))
    assert go() == {"01"}
    assert dict((c, n) for c, _, n in kept(spark, state))["unique"] == 0
    upsert(spark, path, rows(spark, ("c", 9, 10), ("y", 9, None)), "id", "day")
    assert go() == {"02", "09"}
    Ledger(spark, path).replace_parts(rows(spark).limit(0), ("day",), ["day=2024-01-09"])
    assert go() == {"09"}


def test_only_changed_partitions_and_those_that_may_share_a_key_are_opened(
        spark, run, monkeypatch):
    path, state, go = run
    add(spark, path, *((f"k{d}{i}", d, i) for d in range(1, 9) for i in range(5)))
    go()
    opened, real = set(), Ledger.scan

    def watched(self, *args, **options):
        found = real(self, *args, **options)
        if found is not None and self.path == path:
            opened.update(f.rsplit("day=2024-01-", 1)[1][:2] for f in found.inputFiles())
        return found

    add(spark, path, ("k93", 9, 1), ("k42", 9, 2))
    with monkeypatch.context() as m:
        m.setattr(Ledger, "scan", watched)
        assert check_state.check_changes(spark, path, state, "id", checks()) == {"day=2024-01-09"}
    assert opened == {"09", "04"}
    assert kept(spark, state) == full(spark, path)


def test_a_run_that_dies_has_done_nothing(spark, run, monkeypatch):
    path, state, go = run
    add(spark, path, ("a", 1, 1))
    go()
    add(spark, path, ("a", 2, 9))
    before = kept(spark, state)
    with monkeypatch.context() as m:
        m.setattr(ledger, "publish", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            check_state.check_changes(spark, path, state, "id", checks())
    assert kept(spark, state) == before
    assert go() == {"02"}


def test_other_checks_and_forgotten_versions_start_over(spark, run):
    path, state, go = run
    add(spark, path, ("a", 1, 1))
    go()
    add(spark, path, ("a", 2, 9))
    Ledger(spark, path).vacuum(keep=1, older_than=dt.timedelta(days=1))
    assert go() == {"01", "02"}
    more = [*checks(), quality.Check("large", "v", F.col("v") < 5)]
    assert len(check_state.check_changes(spark, path, state, "id", more)) == 2
    assert ("large", "v", 1) in kept(spark, state)
