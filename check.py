"""Run registered queries against their SQL in DuckDB: ``python check.py [sf] [name part ...]``."""

from __future__ import annotations

import math
import sys
import time

import duckdb

from learnlake.queries import ORACLES, QUERIES
from learnlake.session import local_session

TABLES = """region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels
    conversations""".split()


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else float(f"{value:.9g}")
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def duck(folder):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return con


def compare(spark, con, folder, name):
    """``(ok, message, seconds)``."""
    started = time.time()
    df = QUERIES[name](spark, folder)
    mine = rows_of(df.columns, [tuple(r) for r in df.collect()])
    seconds = time.time() - started
    if name not in ORACLES:
        return True, f"{len(mine)} rows (no SQL)", seconds
    cursor = con.execute(ORACLES[name])
    columns = [d[0] for d in cursor.description]
    theirs = rows_of(columns, cursor.fetchall())
    if sorted(columns) != sorted(df.columns):
        return False, f"columns differ: {sorted(set(columns) ^ set(df.columns))}", seconds
    if mine != theirs:
        first = next(((a, b) for a, b in zip(mine, theirs) if a != b), None)
        return False, f"{len(mine)} vs {len(theirs)} rows; first difference {first}", seconds
    return True, f"{len(mine)} rows", seconds


if __name__ == "__main__":
    sf, parts = (sys.argv[1] if len(sys.argv) > 1 else "0.01"), sys.argv[2:]
    folder = f"/root/testdata/sf{sf}"
    spark, con = local_session(), duck(folder)
    failed = 0
    for name in QUERIES:
        if parts and not any(p in name for p in parts):
            continue
        try:
            ok, message, seconds = compare(spark, con, folder, name)
        except Exception as exc:  # noqa: BLE001
            ok, message, seconds = False, f"{type(exc).__name__}: {str(exc)[:600]}", 0.0
        failed += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {name:34s} {seconds:6.2f}s {message}", flush=True)
    print(f"{failed} failed")
    sys.exit(bool(failed))
