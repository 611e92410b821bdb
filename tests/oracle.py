"""Runs registered queries and compares them with their SQL on another engine: columns, row count, every value."""

from __future__ import annotations

import math
import time

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(folder: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _cell(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, float):
        return None if math.isnan(v) else (0.0 if v == 0 else float(f"{v:.9g}"))
    return v if isinstance(v, (int, str)) else f"{type(v).__name__}:{v}"


def _table(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(_cell(r[i]) for i in order) for r in rows]
    return [names[i] for i in order], sorted(out, key=repr)


def compare(spark, con, folder: str, name: str, fn, sql: str | None):
    """(ok, message, seconds)"""
    began = time.time()
    df = fn(spark, folder)
    got = df.collect()
    seconds = time.time() - began
    names, rows = _table(df.columns, got)
    if sql is None:
        return bool(rows), f"{len(rows)} rows, unchecked", seconds
    cur = con.execute(sql)
    want_names, want = _table([d[0] for d in cur.description], cur.fetchall())
    if names != want_names:
        return False, f"columns {names} != {want_names}", seconds
    if len(rows) != len(want):
        return False, f"rows {len(rows)} != {len(want)}", seconds
    bad = [(a, b) for a, b in zip(rows, want) if a != b]
    if bad:
        return False, f"{len(bad)} of {len(rows)} rows differ, first {bad[0]} ({names})", seconds
    kinds = {(i, type(a).__name__, type(b).__name__) for r, w in zip(rows, want) for i, (a, b) in enumerate(zip(r, w)) if type(a) is not type(b)}
    return not kinds, f"{len(rows)} rows" if not kinds else f"types {kinds} {names}", seconds


if __name__ == "__main__":
    import sys

    sys.path.insert(0, ".")
    import __spark_entry__ as entry
    from lossledger.session import local_session

    args = sys.argv[1:]
    folder = f"/root/testdata/sf{args[0]}"
    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    queries, sqls = entry.queries(), entry.oracle_sql()
    from queries.registry import MODULE

    picked = [n for n in queries if not args[1:] or n in args[1:] or MODULE.get(n) in args[1:]]
    failed = []
    for name in picked:
        try:
            ok, message, seconds = compare(spark, con, folder, name, queries[name], sqls.get(name))
        except Exception as e:  # noqa: BLE001
            ok, message, seconds = False, f"{type(e).__name__}: {str(e)[:600]}", 0.0
        if not ok:
            failed.append(name)
        print(f"{'ok  ' if ok else 'FAIL'} {seconds:6.2f} {name}: {message}", flush=True)
    print(f"{len(picked) - len(failed)}/{len(picked)} ok; failed: {failed}")
