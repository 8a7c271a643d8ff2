"""Local twin of the driver's correctness check (Spark query vs DuckDB SQL).

usage: python tools_compare.py [sf_dir] [name ...]
"""
from __future__ import annotations

import hashlib
import math
import sys
import time

import duckdb

from sonora.plans import catalog
from sonora.session import build_session
from sonora.sources.testdata import TABLES


EXACT = bool(int(__import__("os").environ.get("EXACT", "0")))


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(v) if EXACT else repr(round(v, 9))
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return repr(v)


def digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()[:16], lines


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    spark = build_session("local[8]", shuffle_partitions=8)
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    qs, sqls = catalog.QUERIES, catalog.ORACLES
    bad = 0
    for name in names or list(qs):
        t0 = time.time()
        df = qs[name](spark, sf_dir)
        rows = [tuple(r) for r in df.collect()]
        cols = df.columns
        dt = time.time() - t0
        if name not in sqls:
            print(f"{name:32s} rows={len(rows):7d} spark={dt:5.1f}s  (no oracle)")
            continue
        res = con.execute(sqls[name])
        ocols = [d[0] for d in res.description]
        orows = res.fetchall()
        h1, l1 = digest(cols, rows)
        h2, l2 = digest(ocols, orows)
        ok = sorted(cols) == sorted(ocols) and h1 == h2
        bad += not ok
        print(f"{name:32s} rows={len(rows):7d}/{len(orows):7d} spark={dt:5.1f}s "
              f"{'OK' if ok else 'MISMATCH'}")
        if not ok:
            if sorted(cols) != sorted(ocols):
                print("   cols spark :", sorted(cols))
                print("   cols oracle:", sorted(ocols))
            s1, s2 = set(l1), set(l2)
            for x in sorted(s1 - s2)[:3]:
                print("   spark only :", x[:300])
            for x in sorted(s2 - s1)[:3]:
                print("   oracle only:", x[:300])
    print("mismatches:", bad)


if __name__ == "__main__":
    main()
