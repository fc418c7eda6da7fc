"""Run registry queries in Spark and their SQL twins in DuckDB; compare results.

usage: python tools/check_oracle.py [sf_dir] [key ...]

Rows are compared as order-insensitive multisets, columns matched by name.
Exact equality is required; doubles are compared by their exact value.
"""

from __future__ import annotations

import datetime as dt
import json
import math
import sys
import time
from collections import Counter
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else repr(v + 0.0)
    if isinstance(v, dt.datetime):
        return v.isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    return v


def duck_connect(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def compare(spark, con, key: str, fn, sql: str, sf_dir: str) -> dict:
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = sdf.collect()
    t1 = time.time()
    cur = con.execute(sql)
    d_cols = [d[0] for d in cur.description]
    d_rows = cur.fetchall()
    t2 = time.time()
    out = {"key": key, "spark_rows": len(s_rows), "oracle_rows": len(d_rows), "spark_s": round(t1 - t0, 2),
           "oracle_s": round(t2 - t1, 2)}
    if sorted(s_cols) != sorted(d_cols):
        out["status"] = "SCHEMA"
        out["detail"] = {"spark": s_cols, "oracle": d_cols}
        return out
    order = sorted(s_cols)
    si = [s_cols.index(c) for c in order]
    di = [d_cols.index(c) for c in order]
    sc = Counter(tuple(_norm(r[i]) for i in si) for r in s_rows)
    dc = Counter(tuple(_norm(r[i]) for i in di) for r in d_rows)
    if sc == dc:
        out["status"] = "MATCH"
    else:
        out["status"] = "DIFF"
        only_s = list((sc - dc).elements())[:5]
        only_d = list((dc - sc).elements())[:5]
        out["detail"] = {"columns": order, "only_spark": only_s, "only_oracle": only_d,
                         "n_only_spark": sum((sc - dc).values()), "n_only_oracle": sum((dc - sc).values())}
    return out


def main(argv: list[str]) -> int:
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    keys = argv[2:]
    from fleetlens.plans.oracle import oracle_sql
    from fleetlens.plans.registry import queries
    from fleetlens.session import build_session
    spark = build_session("local[8]", 8)
    con = duck_connect(sf_dir)
    qs, sqls = queries(), oracle_sql()
    bad = 0
    for k, fn in qs.items():
        if keys and k not in keys:
            continue
        if k not in sqls:
            print(json.dumps({"key": k, "status": "NO-ORACLE"}))
            continue
        try:
            r = compare(spark, con, k, fn, sqls[k], sf_dir)
        except Exception as e:  # report and continue with the next key
            r = {"key": k, "status": "ERROR", "detail": f"{type(e).__name__}: {str(e)[:800]}"}
        bad += r["status"] != "MATCH"
        print(json.dumps(r, default=str))
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main(sys.argv))
