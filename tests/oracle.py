"""Run registered queries in Spark and their SQL in DuckDB and compare the rows.

`python -m tests.oracle [sf_dir] [name ...]` prints one line per query.
"""

from __future__ import annotations

import decimal
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
from tarn.session import get_session  # noqa: E402

TABLES = """region nation customer supplier part orders lineitem events documents embeddings
pages benchmark labels conversations""".split()


def plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, float) and value != value:
        return "NaN"
    if isinstance(value, float) and value == int(value):
        return int(value)
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i].lower())
    names = [columns[i].lower() for i in order]
    return names, sorted(repr([plain(row[i]) for i in order]) for row in rows)


def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def compare(spark, con, sf_dir, name, run, sql):
    """(ok, message)"""
    df = run(spark, sf_dir)
    got_names, got = normal(df.columns, df.collect())
    if sql is None:
        return bool(got), f"rows only: {len(got)}"
    cursor = con.execute(sql)
    want_names, want = normal([d[0] for d in cursor.description], cursor.fetchall())
    if got_names != want_names:
        return False, f"columns {got_names} != {want_names}"
    if got != want:
        extra = next((r for r in got if r not in set(want)), None)
        lacking = next((r for r in want if r not in set(got)), None)
        return False, f"{len(got)} vs {len(want)} rows; only here {str(extra)[:300]}; only there {str(lacking)[:300]}"
    return True, f"{len(got)} rows"


def local_session():
    return get_session(
        "tests",
        spark__master="local[8]",
        spark__sql__shuffle__partitions="8",
        spark__ui__enabled="false",
        spark__driver__memory="8g",
        spark__sql__warehouse__dir="/tmp/tarn-warehouse",
    )


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = sys.argv[2:]
    spark, con = local_session(), duck(sf_dir)
    spark.sparkContext.setLogLevel("ERROR")
    sqls, failed = entry.oracle_sql(), 0
    for name, run in entry.queries().items():
        if only and name not in only:
            continue
        start = time.time()
        try:
            ok, message = compare(spark, con, sf_dir, name, run, sqls.get(name))
        except Exception as e:  # report and go on
            ok, message = False, f"{type(e).__name__}: {str(e)[:700]}"
        failed += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {name} {time.time() - start:.1f}s {message}", flush=True)
    print("failed:", failed)


if __name__ == "__main__":
    main()
