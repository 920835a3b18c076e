"""Run registered queries in Spark and their SQL twins in DuckDB; compare.

Usage: python tests/oracle_check.py [sf_dir] [name ...]
Prints one line per query and exits non-zero on any mismatch.
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from songgraph.sources.adapters import TABLES  # noqa: E402


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return ("~null",)
    if isinstance(v, float):
        if math.isnan(v):
            return ("~nan",)
        return round(v, 6) + 0.0
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if hasattr(v, "tolist"):
        return _norm(v.tolist())
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    return v


def rows_of(cols, records):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in records]
    return sorted(out, key=repr)


def compare(spark, sf_dir, name, fn, sql, con):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    srows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    rel = con.sql(sql)
    dcols = rel.columns
    drows = rel.fetchall()
    scols = sdf.columns
    ok = sorted(scols) == sorted(dcols)
    msg = ""
    if not ok:
        msg = f"columns {scols} vs {dcols}"
    elif len(srows) != len(drows):
        ok = False
        msg = f"rows {len(srows)} vs {len(drows)}"
    else:
        a, b = rows_of(scols, srows), rows_of(dcols, drows)
        if a != b:
            ok = False
            diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
            msg = f"values differ, e.g. {diff}"
    return ok, len(srows), t1 - t0, msg


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    import __spark_entry__ as E
    from songgraph.session import get_session
    spark = get_session("local[8]", shuffle_partitions=8)
    con = duck(sf_dir)
    qs, ors = E.queries(), E.oracle_sql()
    bad = 0
    for name in names or list(qs):
        if name not in ors:
            df = qs[name](spark, sf_dir)
            n = df.count()
            print(f"{name:28s} rows-only {n}")
            continue
        try:
            ok, n, sec, msg = compare(spark, sf_dir, name, qs[name], ors[name], con)
        except Exception as e:  # report and go on
            ok, n, sec, msg = False, -1, 0.0, f"{type(e).__name__}: {str(e)[:400]}"
        bad += not ok
        print(f"{name:28s} {'OK ' if ok else 'BAD'} rows={n} {sec:.2f}s {msg}", flush=True)
    spark.stop()
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
