"""Compare registered queries with their SQL, row by row and type by type.

Usage: python tests/compare.py [sf_dir] [query ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import os
import sys
import time
import traceback

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()
KINDS = {
    "BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string",
    "TIMESTAMP": "timestamp", "DATE": "date", "BOOLEAN": "boolean",
}


def connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _plain(v):
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    if isinstance(v, decimal.Decimal):
        return float(v)
    return v


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(_plain(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda r: tuple((v is None, str(type(v)), str(v)) for v in r))


def differences(df, con, sql: str) -> str | None:
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    kinds = {d[0]: KINDS.get(str(d[1]), str(d[1])) for d in result.description}
    expected = _rows(names, result.fetchall())
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    spark_kinds = {n: t.replace("timestamp_ntz", "timestamp") for n, t in df.dtypes}
    if spark_kinds != kinds:
        wrong = {n: (spark_kinds[n], kinds[n]) for n in names if spark_kinds[n] != kinds[n]}
        return f"types (spark, sql) {wrong}"
    actual = _rows(df.columns, [tuple(r) for r in df.collect()])
    if len(actual) != len(expected):
        return f"{len(actual)} rows != {len(expected)}"
    for a, e in zip(actual, expected):
        if a != e:
            return f"{sorted(names)}\n  spark {a}\n  sql   {e}"
    return None


def main() -> int:
    import __spark_entry__ as entry
    from lakeline.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    chosen = sys.argv[2:]
    spark = build_session(
        "compare", **{"spark.master": "local[8]", "spark.sql.shuffle.partitions": "8",
                      "spark.driver.memory": "8g", "spark.ui.enabled": "false",
                      "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con, sql, failed = connect(sf_dir), entry.oracle_sql(), []
    for name, run in entry.queries().items():
        if chosen and name not in chosen:
            continue
        started = time.perf_counter()
        try:
            df = run(spark, sf_dir)
            problem = differences(df, con, sql[name]) if name in sql else None
            note = "" if name in sql else f"(no sql, {df.count()} rows)"
        except Exception:
            problem, note = traceback.format_exc(limit=4)[-1500:], ""
        seconds = time.perf_counter() - started
        print(f"{'FAIL' if problem else 'ok  '} {name:28s} {seconds:6.2f}s {note}", flush=True)
        if problem:
            failed.append(name)
            print("  " + problem, flush=True)
    print(f"{len(failed)} failed: {failed}")
    return bool(failed)


if __name__ == "__main__":
    sys.exit(main())
