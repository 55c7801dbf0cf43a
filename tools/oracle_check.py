"""Run registered cases against their DuckDB oracle and report mismatches.

Usage: python tools/oracle_check.py [--sf DIR] [key-or-prefix ...]

Mirrors the driver's gate: same column names, same row count, same
order-insensitive multiset of normalised values.
"""

from __future__ import annotations

import argparse
import datetime as dt
import decimal
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402
import numpy as np  # noqa: E402

from driftwood.tables import TABLES, path  # noqa: E402


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path(sf_dir, t)}')")
    return con


def norm(v):
    if v is None:
        return None
    if isinstance(v, (np.generic,)):
        v = v.item()
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 4) + 0.0
    if isinstance(v, decimal.Decimal):
        return round(float(v), 4) + 0.0
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, (dt.datetime,)):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, dt.timedelta):
        return v.total_seconds()
    if isinstance(v, (bytes, bytearray, memoryview)):
        return bytes(v).hex()
    if isinstance(v, dict):
        return tuple(sorted((str(k), norm(x)) for k, x in v.items()))
    if isinstance(v, np.ndarray):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    if hasattr(v, "asDict"):
        return tuple(norm(x) for x in v)
    return v


def spark_rows(df):
    cols = sorted(df.columns)
    rows = [tuple(norm(r[c]) for c in cols) for r in df.collect()]
    return cols, rows


def duck_rows(con, sql):
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    data = cur.fetchall()
    cols = sorted(names)
    idx = [names.index(c) for c in cols]
    return cols, [tuple(norm(r[i]) for i in idx) for r in data], cur.description


def compare(spark, con, key, fn, sql, sf_dir, verbose=True):
    t0 = time.time()
    df = fn(spark, sf_dir)
    scols, srows = spark_rows(df)
    t1 = time.time()
    if sql is None:
        return {"key": key, "ok": None, "rows": len(srows), "sec": round(t1 - t0, 2)}
    dcols, drows, _ = duck_rows(con, sql)
    ok = scols == dcols and len(srows) == len(drows)
    detail = ""
    if scols != dcols:
        detail = f"cols spark={scols} duck={dcols}"
    else:
        ks = sorted(srows, key=repr)
        kd = sorted(drows, key=repr)
        if ks != kd:
            ok = False
            sd, ss = set(kd), set(ks)
            only_s = [str(r)[:300] for r in ks if r not in sd][:3]
            only_d = [str(r)[:300] for r in kd if r not in ss][:3]
            detail = f"rows {len(ks)} vs {len(kd)}; spark-only {only_s}; duck-only {only_d}"
    return {"key": key, "ok": ok, "rows": len(srows), "sec": round(t1 - t0, 2), "detail": detail}


def main():
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("keys", nargs="*")
    a = ap.parse_args()
    from driftwood.plans.registry import load_all, queries
    from driftwood.session import build_session

    spark = build_session()
    con = duck(a.sf)
    cases = load_all()
    qs = queries()
    sel = [k for k in cases if not a.keys or any(k == p or k.startswith(p) for p in a.keys)]
    bad = 0
    for k in sel:
        c = cases[k]
        try:
            r = compare(spark, con, k, qs[k], c.sql, a.sf)
        except Exception as e:  # report and continue
            r = {"key": k, "ok": False, "detail": f"{type(e).__name__}: {str(e)[:400]}"}
        if r["ok"] is False:
            bad += 1
        print(("OK  " if r["ok"] else ("--  " if r["ok"] is None else "BAD ")) + k,
              r.get("rows"), r.get("sec"), r.get("detail", ""), flush=True)
    print(f"{len(sel)} cases, {bad} bad")


if __name__ == "__main__":
    main()
