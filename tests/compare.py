"""Run registered queries in Spark and their oracle SQL in DuckDB; compare results.

Usage: python tests/compare.py [sf_dir] [query ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def _norm(v):
    if v is None:
        return "∅"
    if isinstance(v, float):
        return f"{v:.6g}"
    if isinstance(v, decimal.Decimal):
        return f"{v.normalize():f}" if v == v.to_integral() else f"{v:f}".rstrip("0")
    if isinstance(v, dt.datetime):
        return v.isoformat(sep=" ")
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    return str(v)


def digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()[:16], lines


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def compare(spark, sf_dir, names=None, verbose=True):
    import __spark_entry__ as E
    qs, sql = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    results = {}
    for name in names or sorted(qs):
        t0 = time.time()
        try:
            df = qs[name](spark, sf_dir)
            srows = [tuple(r) for r in df.collect()]
            scols = df.columns
        except Exception as e:  # noqa: BLE001
            results[name] = ("SPARK-ERROR", str(e)[:300])
            print(name, "SPARK-ERROR", str(e)[:2000])
            continue
        ts = time.time() - t0
        if name not in sql:
            results[name] = ("NO-ORACLE", len(srows))
            print(f"{name:32s} rows={len(srows):7d} no oracle  spark={ts:.1f}s")
            continue
        try:
            cur = con.execute(sql[name])
            dcols = [d[0] for d in cur.description]
            drows = cur.fetchall()
        except Exception as e:  # noqa: BLE001
            results[name] = ("DUCK-ERROR", str(e)[:300])
            print(name, "DUCK-ERROR", str(e)[:2000])
            continue
        sh, sl = digest(scols, srows)
        dh, dl = digest(dcols, drows)
        ok = sorted(scols) == sorted(dcols) and len(srows) == len(drows) and sh == dh
        results[name] = ("OK" if ok else "MISMATCH", len(srows), len(drows))
        print(f"{name:32s} {'OK' if ok else 'MISMATCH':8s} rows={len(srows)}/{len(drows)} spark={ts:.1f}s")
        if not ok and verbose:
            if sorted(scols) != sorted(dcols):
                print("   cols spark:", sorted(scols), "\n   cols duck: ", sorted(dcols))
            a, b = set(sl), set(dl)
            for x in sorted(a - b)[:3]:
                print("   spark-only:", x[:300])
            for x in sorted(b - a)[:3]:
                print("   duck-only: ", x[:300])
    return results


if __name__ == "__main__":
    from remitflow.session import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8)
    if os.environ.get("REMITFLOW_HOT_ROWS"):
        spark.conf.set("remitflow.hotGroupRows", os.environ["REMITFLOW_HOT_ROWS"])
    res = compare(spark, sf, sys.argv[2:] or None)
    bad = [k for k, v in res.items() if v[0] not in ("OK", "NO-ORACLE")]
    print("FAILED:", bad if bad else "none")
