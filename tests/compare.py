"""Run registered queries in Spark and their oracle SQL in DuckDB; compare.

Comparison: same column names, same row count, same multiset of rows
(columns sorted by name, floats rounded, dates as ISO text).

CLI: python -m tests.compare [--sf DIR] [name ...]
"""

from __future__ import annotations

import argparse
import datetime as dt
import math
import os
import sys
import time

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    if hasattr(v, "asDict"):
        return _norm(v.asDict())
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r))


def compare(spark, name: str, fn, sql: str, sf_dir: str, con=None) -> dict:
    con = con or duck(sf_dir)
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    con.execute(f"CREATE OR REPLACE VIEW oracle_{name} AS {sql}")  # as the driver runs it
    res = con.execute(f"SELECT * FROM oracle_{name}")
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    t2 = time.time()
    out = {"name": name, "spark_rows": len(s_rows), "oracle_rows": len(d_rows),
           "spark_s": round(t1 - t0, 2), "oracle_s": round(t2 - t1, 2)}
    if sorted(s_cols) != sorted(d_cols):
        out["ok"] = False
        out["why"] = f"columns {sorted(s_cols)} != {sorted(d_cols)}"
        return out
    a, b = _rows(s_cols, s_rows), _rows(d_cols, d_rows)
    out["ok"] = a == b
    if not out["ok"]:
        sa, sb = set(a), set(b)
        out["why"] = (f"only spark: {list(sa - sb)[:3]} | only oracle: {list(sb - sa)[:3]}")
    return out


def main(argv=None) -> int:
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from civiq.registry import REGISTRY
    from civiq.session import get_session

    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("names", nargs="*")
    args = ap.parse_args(argv)
    spark = get_session("local[8]", 8)
    con = duck(args.sf)
    bad = 0
    for name, (fn, sql) in REGISTRY.items():
        if args.names and name not in args.names:
            continue
        if sql is None:
            df = fn(spark, args.sf)
            print(f"{name:32s} rows-only {df.count()}")
            continue
        try:
            r = compare(spark, name, fn, sql, args.sf, con)
        except Exception as e:  # report and continue
            r = {"name": name, "ok": False, "why": f"{type(e).__name__}: {str(e)[:400]}"}
        bad += not r["ok"]
        print(f"{name:32s} {'OK ' if r['ok'] else 'BAD'} {r.get('spark_rows')}/"
              f"{r.get('oracle_rows')} {r.get('spark_s')}s {r.get('why', '')}", flush=True)
    print("FAILED:", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main())
