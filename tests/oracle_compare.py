"""Run registered queries in Spark and their SQL in DuckDB and compare
row count, column names and an order-insensitive hash of the values.

Usage: python tests/oracle_compare.py [sf_dir] [name-prefix ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib
import math
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck_conn(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v, digits=None):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        if digits is not None:
            return round(v, digits)
        return v
    if isinstance(v, decimal.Decimal):
        return _norm(float(v), digits)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x, digits) for x in v)
    if hasattr(v, "asDict"):
        return tuple(sorted((k, _norm(x, digits)) for k, x in v.asDict().items()))
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x, digits)) for k, x in v.items()))
    return v


def rows_hash(cols, rows, digits=None):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    keyed = sorted(repr(tuple(_norm(r[i], digits) for i in order)) for r in rows)
    return hashlib.sha1("\n".join(keyed).encode()).hexdigest(), keyed


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    res = con.execute(sql)
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    t2 = time.time()
    out = {"name": name, "spark_s": round(t1 - t0, 2), "duck_s": round(t2 - t1, 2),
           "rows": (len(s_rows), len(d_rows)), "cols_ok": sorted(s_cols) == sorted(d_cols)}
    hs, ks = rows_hash(s_cols, s_rows)
    hd, kd = rows_hash(d_cols, d_rows)
    out["exact"] = hs == hd
    if not out["exact"]:
        out["approx9"] = rows_hash(s_cols, s_rows, 9)[0] == rows_hash(d_cols, d_rows, 9)[0]
        diff_s = sorted(set(ks) - set(kd))[:3]
        diff_d = sorted(set(kd) - set(ks))[:3]
        out["only_spark"] = diff_s
        out["only_duck"] = diff_d
    if not out["cols_ok"]:
        out["spark_cols"] = sorted(s_cols)
        out["duck_cols"] = sorted(d_cols)
    return out


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    prefixes = argv[2:]
    from basketry.session import get_spark
    import __spark_entry__ as e

    spark = get_spark()
    con = duck_conn(sf_dir)
    qs = e.queries()
    sql = e.oracle_sql()
    bad = 0
    for name in sorted(qs):
        if prefixes and not any(name.startswith(p) for p in prefixes):
            continue
        if name not in sql:
            t0 = time.time()
            n = qs[name](spark, sf_dir).count()
            print({"name": name, "rows_only": n, "spark_s": round(time.time() - t0, 2)}, flush=True)
            continue
        try:
            r = compare(spark, con, name, qs[name], sql[name], sf_dir)
        except Exception as exc:  # noqa: BLE001
            r = {"name": name, "error": repr(exc)[:800]}
        ok = r.get("exact") and r.get("cols_ok") and r["rows"][0] == r["rows"][1]
        bad += 0 if ok else 1
        print(("OK  " if ok else "BAD ") + repr(r), flush=True)
    print("mismatches:", bad)


if __name__ == "__main__":
    main(sys.argv)
