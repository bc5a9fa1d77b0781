"""Run registered queries in Spark and their oracle SQL in DuckDB; compare.

Usage: python tools/oracle_check.py [--sf /root/testdata/sf0.01] [name ...]
Compares row count, sorted column names and an order-insensitive hash of
the values (floats printed to 10 significant digits).
"""

from __future__ import annotations

import argparse
import hashlib
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from flowlens.plans.registry import load_all  # noqa: E402
from flowlens.plans.views import BASE_TABLES  # noqa: E402
from flowlens.session import get_spark  # noqa: E402


def canon(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NULL"
        if v == 0:
            return "0"
        return f"{v:.10g}"
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(canon(x) for x in v) + "]"
    if hasattr(v, "tolist"):
        return canon(v.tolist())
    if isinstance(v, bool):
        return str(int(v))
    if isinstance(v, int):
        return str(v)
    if isinstance(v, dict):
        return "{" + ",".join(f"{k}:{canon(x)}" for k, x in sorted(v.items())) + "}"
    if hasattr(v, "asDict"):
        return canon(v.asDict())
    if hasattr(v, "isoformat"):
        try:
            return v.isoformat(sep=" ")
        except TypeError:  # datetime.date
            return v.isoformat()
    return str(v)


def digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i].lower())
    lines = sorted("|".join(canon(r[i]) for i in order) for r in rows)
    return hashlib.sha1("\n".join(lines).encode()).hexdigest()[:12], lines


def main():
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("--show", action="store_true")
    ap.add_argument("names", nargs="*")
    a = ap.parse_args()
    reg = load_all()
    names = a.names or sorted(reg)
    spark = get_spark()
    con = duckdb.connect()
    for t in BASE_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{a.sf}/{t}.parquet')")
    bad = 0
    for n in names:
        spec = reg[n]
        t0 = time.time()
        try:
            sdf = spec.fn(spark, a.sf)
            scols = sdf.columns
            srows = [tuple(r) for r in sdf.collect()]
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {n}: spark error {type(e).__name__}: {str(e)[:400]}")
            bad += 1
            continue
        ts = time.time() - t0
        if spec.oracle is None:
            print(f"ROWS {n}: {len(srows)} rows ({ts:.1f}s)")
            continue
        try:
            t1 = time.time()
            res = con.execute(spec.oracle)
            ocols = [d[0] for d in res.description]
            orows = res.fetchall()
            to = time.time() - t1
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {n}: duckdb error {str(e)[:400]}")
            bad += 1
            continue
        ok_cols = sorted(c.lower() for c in scols) == sorted(c.lower() for c in ocols)
        hs, ls = digest(scols, srows)
        ho, lo = digest(ocols, orows)
        if ok_cols and len(srows) == len(orows) and hs == ho:
            print(f"OK   {n}: {len(srows)} rows spark {ts:.1f}s duckdb {to:.2f}s")
        else:
            bad += 1
            print(f"FAIL {n}: rows {len(srows)} vs {len(orows)}; cols {sorted(scols)} vs {sorted(ocols)}")
            so, ss = set(lo), set(ls)
            diff_s = [x for x in ls if x not in so][:5]
            diff_o = [x for x in lo if x not in ss][:5]
            print("   spark-only :", diff_s)
            print("   oracle-only:", diff_o)
        if a.show:
            print("   ", scols, srows[:3])
    print(f"{len(names) - bad}/{len(names)} passed")
    spark.stop()


if __name__ == "__main__":
    main()
