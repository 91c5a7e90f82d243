"""Run a query on Spark and its SQL on DuckDB and compare all rows."""

from __future__ import annotations

import collections
import datetime as dt
import glob
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def plain(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, float):
        return "nan" if math.isnan(v) else ("f", v + 0.0 if v else 0.0)
    if isinstance(v, dt.datetime):
        return ("t", v.replace(tzinfo=None).isoformat())
    if isinstance(v, dt.date):
        return ("d", v.isoformat())
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    return v


def bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), collections.Counter(tuple(plain(r[i]) for i in order) for r in rows)


def duck(folder):
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path)[:-8]
        con.execute(f"create view {name} as select * from '{path}'")
    return con


def check(spark, folder, name, query, oracle, con=None):
    """(rows, seconds, problem or None)"""
    start = time.time()
    df = query(spark, folder)
    got = df.collect()
    took = time.time() - start
    if oracle is None:
        return len(got), took, None if got else "no rows"
    rel = (con or duck(folder)).sql(oracle)
    cols_a, a = bag(df.columns, got)
    cols_b, b = bag(rel.columns, rel.fetchall())
    if cols_a != cols_b:
        return len(got), took, f"columns {cols_a} vs {cols_b}"
    if not got:
        return 0, took, "no rows"
    if a != b:
        only_a, only_b = list((a - b).items())[:2], list((b - a).items())[:2]
        return len(got), took, f"{sum((a - b).values())} rows differ of {sum(a.values())}/{sum(b.values())}: {only_a} | {only_b}"
    return len(got), took, None


if __name__ == "__main__":
    from bidlens.session import build_session
    import __spark_entry__ as entry

    sf = sys.argv[1]
    picked = sys.argv[2:]
    folder = f"/root/testdata/sf{sf}"
    spark = build_session("compare", "local[8]", spark__sql__shuffle__partitions="8",
                          spark__driver__memory="12g")
    spark.sparkContext.setLogLevel("ERROR")
    con, sql = duck(folder), entry.oracle_sql()
    failed = 0
    for name, fn in entry.queries().items():
        if picked and not any(name == p or (p.endswith("*") and name.startswith(p[:-1])) for p in picked):
            continue
        try:
            rows, took, problem = check(spark, folder, name, fn, sql.get(name), con)
        except Exception as e:  # report and go on
            rows, took, problem = -1, 0, f"{type(e).__name__}: {str(e)[:700]}"
        failed += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name:32s} rows={rows:<8d} {took:6.2f}s "
              f"{'oracle' if name in sql else 'rows-only'} {problem or ''}", flush=True)
    print("failed", failed)
