"""Run registered Spark queries and their DuckDB oracles side by side.

Compares row count, column names and an order-insensitive hash of the
values, like the correctness gate. Usage:
    python tools/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from cartwheel.session import build_session  # noqa: E402
from cartwheel.plans.registry import oracles, queries  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def norm(v):
    if isinstance(v, float):
        return repr(round(v, 9))
    if isinstance(v, decimal.Decimal):
        return format(v.normalize(), "f") if v == v else "nan"
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    return repr(v)


def digest(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(norm(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()[:16], lines


def main():
    args = sys.argv[1:]
    sf_dir = args[0] if args and os.path.isdir(args[0]) else "/root/testdata/sf0.01"
    names = [a for a in args if not os.path.isdir(a)]
    spark = build_session("local[8]", 8)
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    q, o = queries(), oracles()
    bad = 0
    for name in names or list(q):
        t0 = time.time()
        try:
            df = q[name](spark, sf_dir)
            cols = df.columns
            rows = [tuple(r) for r in df.collect()]
        except Exception as e:  # noqa: BLE001
            print(f"{name:40s} SPARK-ERROR {str(e)[:300]}")
            bad += 1
            continue
        ts = time.time() - t0
        if name not in o:
            print(f"{name:40s} rows={len(rows):7d} (no oracle) {ts:.1f}s")
            continue
        try:
            res = con.execute(o[name])
            ocols = [d[0] for d in res.description]
            orows = res.fetchall()
        except Exception as e:  # noqa: BLE001
            print(f"{name:40s} ORACLE-ERROR {str(e)[:300]}")
            bad += 1
            continue
        h1, l1 = digest(rows, cols)
        h2, l2 = digest(orows, ocols)
        ok = len(rows) == len(orows) and sorted(cols) == sorted(ocols) and h1 == h2
        bad += not ok
        print(f"{name:40s} rows={len(rows):7d}/{len(orows):7d} cols={'ok' if sorted(cols)==sorted(ocols) else 'DIFF'} "
              f"hash={'ok' if h1 == h2 else 'DIFF'} {ts:.1f}s")
        if not ok:
            if sorted(cols) != sorted(ocols):
                print("   spark:", sorted(cols)); print("   duck :", sorted(ocols))
            s1, s2 = set(l1), set(l2)
            for x in list(s1 - s2)[:2]:
                print("   spark-only:", x[:400])
            for x in list(s2 - s1)[:2]:
                print("   duck-only :", x[:400])
    print(f"FAILED {bad}" if bad else "ALL OK")
    spark.stop()


if __name__ == "__main__":
    main()
