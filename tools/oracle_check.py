"""Run registered queries on Spark and their oracle SQL on DuckDB; compare results.

usage: python tools/oracle_check.py [sf_dir] [key ...]
Compares row count, column names, and the order-insensitive multiset of rows
(floats rounded to 6 places, columns sorted by name).
"""

from __future__ import annotations

import math
import os
import sys
import time
import traceback

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from tessera.plans.registry import load_all  # noqa: E402
from tessera.session import build_session  # noqa: E402
from tessera.sources.tables import TABLES  # noqa: E402


def norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return f"{round(v, 6):.6f}"
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(norm(x) for x in v) + "]"
    if isinstance(v, bool):
        return str(v)
    if hasattr(v, "item"):
        return norm(v.item())
    return str(v)


_FAMILY = {"bigint": "int64", "BIGINT": "int64", "HUGEINT": "int128", "int": "int32", "INTEGER": "int32",
           "smallint": "int16", "SMALLINT": "int16", "double": "float64", "DOUBLE": "float64", "float": "float32",
           "FLOAT": "float32", "string": "string", "VARCHAR": "string", "boolean": "bool", "BOOLEAN": "bool",
           "date": "date", "DATE": "date", "timestamp_ntz": "timestamp", "TIMESTAMP": "timestamp",
           "timestamp": "timestamptz", "binary": "binary", "BLOB": "binary"}


def family(t):
    t = str(t)
    if t.startswith("array") or t.endswith("[]"):
        return "list"
    if t.startswith("decimal") or t.startswith("DECIMAL"):
        return "decimal"
    return _FAMILY.get(t, t)


def canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return [tuple(norm(r[i]) for i in order) for r in rows]


def main():
    args = sys.argv[1:]
    sf = "/root/testdata/sf0.01"
    if args and args[0].startswith("/"):
        sf, args = args[0], args[1:]
    reg = load_all()
    keys = args or sorted(reg)
    spark = build_session("local[8]", 8)
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    ok = bad = 0
    for k in keys:
        fn, sql = reg[k]
        t0 = time.time()
        try:
            df = fn(spark, sf)
            scols = df.columns
            srows = [tuple(r) for r in df.collect()]
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {k}: spark error {type(e).__name__}: {str(e)[:400]}")
            traceback.print_exc(limit=3)
            bad += 1
            continue
        ts = time.time() - t0
        if sql is None:
            print(f"ROWS {k}: {len(srows)} rows (no oracle) {ts:.1f}s")
            ok += 1
            continue
        try:
            cur = con.execute(sql)
            dcols = [d[0] for d in cur.description]
            drows = cur.fetchall()
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {k}: duckdb error {str(e)[:400]}")
            bad += 1
            continue
        stypes = {n: family(t) for n, t in df.dtypes}
        dtypes_ = {d[0]: family(d[1]) for d in cur.description}
        tdiff = {n: (stypes[n], dtypes_.get(n)) for n in stypes if stypes[n] != dtypes_.get(n)}
        if tdiff:
            print(f"TYPE {k}: {tdiff}")
        if sorted(scols) != sorted(dcols):
            print(f"FAIL {k}: columns spark={sorted(scols)} duck={sorted(dcols)}")
            bad += 1
            continue
        a, b = sorted(canon(scols, srows)), sorted(canon(dcols, drows))
        if a != b:
            sa, sb = set(a), set(b)
            print(f"FAIL {k}: rows spark={len(a)} duck={len(b)}; only-spark={sorted(sa - sb)[:3]} only-duck={sorted(sb - sa)[:3]}")
            bad += 1
        else:
            print(f"OK   {k}: {len(a)} rows {ts:.1f}s")
            ok += 1
    print(f"summary ok={ok} bad={bad}")


if __name__ == "__main__":
    main()
