"""Run registered queries in Spark and their SQL in DuckDB, and compare whole results."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

import duckdb  # noqa: E402

import __spark_entry__ as entry  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9) + 0.0
    if isinstance(value, int):
        return float(value)
    return value


def database(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, con, sf_dir: str, name: str) -> str:
    started = time.time()
    df = entry.queries()[name](spark, sf_dir)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    seconds = time.time() - started
    sql = entry.oracle_sql().get(name)
    if sql is None:
        return f"rows-only {len(got[1])} rows {seconds:.1f}s"
    result = con.execute(sql)
    want = rows_of([c[0] for c in result.description], result.fetchall())
    if got[0] != want[0]:
        return f"COLUMNS differ: {set(got[0]) ^ set(want[0])}"
    if got[1] != want[1]:
        diff = [(a, b) for a, b in zip(got[1], want[1]) if a != b][:2]
        return f"ROWS differ: {len(got[1])} vs {len(want[1])}: {got[0]} {diff}"
    return f"ok {len(got[1])} rows {seconds:.1f}s"


if __name__ == "__main__":
    from reqlytics.session import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(entry.queries())
    session, con = local_session("8"), database(sf)
    for n in names:
        try:
            print(n, compare(session, con, sf, n), flush=True)
        except Exception as error:  # report and go on with the next query
            print(n, "FAILED", type(error).__name__, str(error)[:400].replace("\n", " "), flush=True)
