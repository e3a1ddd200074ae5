"""Every registered query against its SQL on the smallest given tables."""

import os
import subprocess
import sys

import pytest

import __spark_entry__ as entry
from compare import connect, differences
from lakeline.catalog.oracle import oracle
from lakeline.catalog.queries import QUERIES

SF = os.environ.get("LAKELINE_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = entry.queries()[name](spark, SF)
    assert differences(df, con, entry.oracle_sql()[name]) is None


def test_comparison_notices_a_difference(spark, con):
    df = entry.queries()["q_city_count"](spark, SF)
    sql = entry.oracle_sql()["q_city_count"]
    assert differences(df, con, sql.replace("count(*) AS orders", "count(*) + 1 AS orders"))
    assert differences(df, con, sql + " HAVING city <> 'hcmc'")


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_registry_needs_no_session():
    assert set(QUERIES) == set(oracle())
    code = ("import __spark_entry__ as e; q, o = e.queries(), e.oracle_sql(); "
            "assert set(o) <= set(q), set(o) - set(q); print(len(q))")
    root = os.path.dirname(os.path.abspath(entry.__file__))
    done = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr
