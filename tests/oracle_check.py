"""Run registered queries in Spark and their oracle SQL in DuckDB; compare.

Usage: python tests/oracle_check.py [sf_dir] [name ...]
Mirrors the driver's gate: row count, sorted column names, and an
order-insensitive multiset of rows (floats rounded to 6 decimals).
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time
from types import SimpleNamespace

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        r = round(v, 6)
        return 0.0 if r == 0 else r
    if isinstance(v, decimal.Decimal):
        return norm(float(v))
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, norm(x)) for k, x in v.items()))
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if hasattr(v, "asDict"):
        return tuple(norm(x) for x in v)
    if hasattr(v, "tolist"):
        return norm(v.tolist())
    return v


def rows_key(rows):
    return sorted((tuple(norm(x) for x in r) for r in rows), key=repr)


def duck_conn(sf_dir):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def compare(spark, con, spec, sf_dir):
    t0 = time.time()
    sdf = spec.fn(spark, sf_dir)
    scols = sdf.columns
    srows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    if spec.sql is None:
        return {"name": spec.name, "ok": None, "rows": len(srows), "spark_s": round(t1 - t0, 2)}
    cur = con.execute(spec.sql)
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    res = {"name": spec.name, "rows": len(srows), "duck_rows": len(drows), "spark_s": round(t1 - t0, 2)}
    if sorted(scols) != sorted(dcols):
        res.update(ok=False, why=f"cols spark={scols} duck={dcols}")
        return res
    order = sorted(scols)
    si = [scols.index(c) for c in order]
    di = [dcols.index(c) for c in order]
    a = rows_key([[r[i] for i in si] for r in srows])
    b = rows_key([[r[i] for i in di] for r in drows])
    if a == b:
        res["ok"] = True
    else:
        sa, sb = set(map(repr, a)), set(map(repr, b))
        res.update(ok=False, why=f"spark-only {sorted(sa - sb)[:3]} duck-only {sorted(sb - sa)[:3]}")
    return res


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 and argv[1].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in argv[1:] if not a.startswith("/")]
    import __spark_entry__
    from labelkiln.session import build_session
    sql = __spark_entry__.oracle_sql()
    reg = {n: SimpleNamespace(name=n, fn=fn, sql=sql.get(n)) for n, fn in __spark_entry__.queries().items()}
    spark = build_session()
    con = duck_conn(sf_dir)
    unknown = [n for n in names if not any(name.startswith(n) for name in reg)]
    if unknown:
        print(f"no query is named {', '.join(unknown)}")
        return 1
    bad = 0
    for name, spec in reg.items():
        if names and not any(name.startswith(n) for n in names):
            continue
        try:
            r = compare(spark, con, spec, sf_dir)
        except Exception as e:  # report and continue
            r = {"name": name, "ok": False, "why": f"{type(e).__name__}: {str(e)[:300]}"}
        bad += r.get("ok") is False
        print(r, flush=True)
    print(f"FAILED {bad}" if bad else "ALL OK")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
