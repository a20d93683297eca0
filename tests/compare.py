"""Run Spark queries and their DuckDB oracles side by side (like the driver).

Usage: python tests/compare.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


EXACT = os.environ.get("COMPARE_EXACT") == "1"


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return v if EXACT else round(v, 6)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if v is None:
        return None
    if isinstance(v, (int, str)):
        return v
    try:
        return float(v)
    except Exception:  # noqa: BLE001
        return str(v)


def canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


def compare(spark, sf_dir, names=None, verbose=True):
    from __spark_entry__ import oracle_sql, queries

    qs, orc = queries(), oracle_sql()
    con = duck(sf_dir)
    results = {}
    for name in names or list(qs):
        t0 = time.time()
        try:
            sdf = qs[name](spark, sf_dir)
            scols = sdf.columns
            srows = [tuple(r) for r in sdf.collect()]
        except Exception as exc:  # noqa: BLE001
            results[name] = f"SPARK ERROR {type(exc).__name__}: {str(exc)[:400]}"
            print(name, results[name], flush=True)
            continue
        ts = time.time() - t0
        if name not in orc:
            results[name] = f"no-oracle rows={len(srows)}"
            print(f"{name:32s} {results[name]} spark={ts:.2f}s", flush=True)
            continue
        try:
            cur = con.execute(orc[name])
            ocols = [d[0] for d in cur.description]
            orows = cur.fetchall()
        except Exception as exc:  # noqa: BLE001
            results[name] = f"ORACLE ERROR {str(exc)[:400]}"
            print(name, results[name], flush=True)
            continue
        status = []
        if sorted(scols) != sorted(ocols):
            status.append(f"cols spark={sorted(set(scols) - set(ocols))} oracle={sorted(set(ocols) - set(scols))}")
        if len(srows) != len(orows):
            status.append(f"rows spark={len(srows)} oracle={len(orows)}")
        if not status:
            a, b = canon(scols, srows), canon(ocols, orows)
            if a != b:
                diff = [(x, y) for x, y in zip(a, b) if x != y]
                status.append(f"values differ in {len(diff)} rows; first: {diff[:2]}")
        results[name] = "OK" if not status else "; ".join(status)
        if verbose:
            print(f"{name:32s} {results[name][:600]} rows={len(srows)} spark={ts:.2f}s", flush=True)
    return results


if __name__ == "__main__":
    from tradewh.session import build_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or None
    spark = build_session()
    res = compare(spark, sf, names)
    bad = {k: v for k, v in res.items() if v != "OK" and not v.startswith("no-oracle")}
    print(f"\n{len(res) - len(bad)}/{len(res)} OK")
    sys.exit(1 if bad else 0)
