"""Compare registered Spark queries with their DuckDB oracle SQL.

Usage: python tests/oracle_compare.py [sf_dir] [query ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = Path(sf_dir) / f"{t}.parquet"
        if p.exists():
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    if hasattr(v, "asDict"):
        return _norm(v.asDict())
    if hasattr(v, "tolist"):
        return _norm(v.tolist())
    return v


def _key(row):
    return tuple((x is None, str(type(x)), x if x is not None else 0) for x in row)


def compare(spark, name: str, sf_dir: str, con=None) -> dict:
    from __spark_entry__ import oracle_sql, queries
    con = con or duck(sf_dir)
    t0 = time.time()
    sdf = queries()[name](spark, sf_dir)
    srows = [r.asDict(recursive=True) for r in sdf.collect()]
    t1 = time.time()
    sql = oracle_sql().get(name)
    out = {"query": name, "spark_rows": len(srows), "spark_sec": round(t1 - t0, 2)}
    if sql is None:
        out["status"] = "no-oracle"
        return out
    cur = con.execute(sql)
    cols = [d[0] for d in cur.description]
    drows = [dict(zip(cols, r)) for r in cur.fetchall()]
    out["oracle_rows"] = len(drows)
    scols = sorted(sdf.columns)
    if sorted(cols) != scols:
        out["status"] = f"COLUMNS spark={scols} oracle={sorted(cols)}"
        return out
    a = sorted((tuple(_norm(r[c]) for c in scols) for r in srows), key=_key)
    b = sorted((tuple(_norm(r[c]) for c in scols) for r in drows), key=_key)
    if len(a) != len(b):
        out["status"] = "ROWCOUNT"
    elif a != b:
        diff = [(x, y) for x, y in zip(a, b) if x != y]
        out["status"] = f"VALUES {len(diff)} differ; first: spark={diff[0][0]} oracle={diff[0][1]} cols={scols}"
    else:
        out["status"] = "OK"
    return out


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 and "/" in argv[1] else "/root/testdata/sf0.01"
    names = [a for a in argv[1:] if "/" not in a]
    from lakepipe.session import build_session
    spark = build_session("local[8]", shuffle_partitions=8)
    from __spark_entry__ import queries
    con = duck(sf_dir)
    bad = 0
    for n in names or list(queries()):
        try:
            r = compare(spark, n, sf_dir, con)
        except Exception as e:  # report and continue
            r = {"query": n, "status": f"ERROR {type(e).__name__}: {str(e)[:400]}"}
        bad += r["status"] not in ("OK", "no-oracle")
        print(r, flush=True)
    print(f"mismatches: {bad}")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
