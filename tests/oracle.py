"""Runs registered queries against DuckDB on the given tables."""

from __future__ import annotations

import glob
import math
import os
import sys
import time

import duckdb

SF_DIR = os.environ.get("TW_SF_DIR", "/root/testdata/sf0.001")


def connect(sf_dir: str = SF_DIR):
    con = duckdb.connect()
    con.execute("set timezone='UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"create view {name} as select * from read_parquet('{path}')")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6)
    if value is None or isinstance(value, (bool, int, str)):
        return value
    if hasattr(value, "isoformat"):
        return value.isoformat()
    return repr(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(plain(r[i]) for i in order) for r in rows]
    return sorted(columns), sorted(out, key=repr)


def compare(spark, con, name, sf_dir=SF_DIR):
    """None when equal, else a short description of the difference."""
    from tradewind.checks import load
    from tradewind.checks.registry import ORACLE, QUERIES, oracle_text
    load()
    df = QUERIES[name](spark, sf_dir)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if name not in ORACLE:
        return None if got[1] or name.startswith("k") else "no rows"
    cur = con.execute(oracle_text(ORACLE[name]))
    want = rows_of([d[0] for d in cur.description], cur.fetchall())
    if got[0] != want[0]:
        return f"columns {got[0]} != {want[0]}"
    if len(got[1]) != len(want[1]):
        return f"{len(got[1])} rows != {len(want[1])}"
    for g, w in zip(got[1], want[1]):
        if g != w:
            return f"{g} != {w}"
    return None


if __name__ == "__main__":
    from tradewind.checks import load
    from tradewind.checks.registry import ORACLE, QUERIES
    from tradewind.session import local_session
    load()
    spark = local_session(cores=8)
    con = connect()
    wanted = sys.argv[1:]
    failed = 0
    for key in QUERIES:
        if wanted and not any(key == w or key.startswith(w + "_") or (w.endswith("*") and key.startswith(w[:-1])) for w in wanted):
            continue
        t0 = time.time()
        try:
            diff = compare(spark, con, key)
        except Exception as e:  # report and go on with the next query
            diff = f"{type(e).__name__}: {str(e)[:600]}"
        failed += diff is not None
        mark = "" if key in ORACLE else " (rows only)"
        print(f"{'ok  ' if diff is None else 'FAIL'} {key}{mark} {time.time() - t0:.2f}s {diff or ''}", flush=True)
    print("failed:", failed)
