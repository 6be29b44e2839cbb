"""Compare registered Spark queries with their DuckDB oracles (like the driver does).

Usage: python tests/oracle_compare.py [sf_dir] [name ...]
"""

from __future__ import annotations

import hashlib
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from pagewright.sources.tables import TABLES, table_path  # noqa: E402


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(round(v, 6))
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    if isinstance(v, dict):
        return "{" + ",".join(f"{k}:{_norm(x)}" for k, x in sorted(v.items())) + "}"
    return repr(v)


def digest(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()[:16]


def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(sf_dir, t)}')")
    return con


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    import __spark_entry__ as E
    from pagewright.session import get_session
    spark = get_session("local[8]", 8)
    qs, oracle = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    bad = 0
    for name, fn in qs.items():
        if names and name not in names:
            continue
        t0 = time.time()
        try:
            df = fn(spark, sf_dir)
            cols = df.columns
            rows = [tuple(r) for r in df.collect()]
        except Exception as e:  # noqa: BLE001
            print(f"{name:28s} SPARK-ERROR {str(e)[:300]}")
            bad += 1
            continue
        ts = time.time() - t0
        if name not in oracle:
            print(f"{name:28s} rows={len(rows)} (no oracle) {ts:.1f}s")
            continue
        try:
            r = con.execute(oracle[name])
            ocols = [d[0] for d in r.description]
            orows = r.fetchall()
        except Exception as e:  # noqa: BLE001
            print(f"{name:28s} DUCK-ERROR {str(e)[:300]}")
            bad += 1
            continue
        ok_cols = sorted(cols) == sorted(ocols)
        ok = ok_cols and len(rows) == len(orows) and digest(cols, rows) == digest(ocols, orows)
        print(f"{name:28s} {'OK ' if ok else 'BAD'} rows={len(rows)}/{len(orows)} cols_ok={ok_cols} {ts:.1f}s")
        if not ok:
            bad += 1
            if ok_cols:
                order = sorted(range(len(cols)), key=lambda i: cols[i])
                oorder = sorted(range(len(ocols)), key=lambda i: ocols[i])
                a = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
                b = sorted("|".join(_norm(r[i]) for i in oorder) for r in orows)
                sa, sb = set(a), set(b)
                for x in [x for x in a if x not in sb][:2]:
                    print("   spark-only:", x[:600])
                for x in [x for x in b if x not in sa][:2]:
                    print("   duck-only: ", x[:600])
            else:
                print("   cols", sorted(cols), sorted(ocols))
    print("BAD", bad)


if __name__ == "__main__":
    main()
