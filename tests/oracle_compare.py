"""Compare each catalog query with its DuckDB oracle (the driver's correctness gate, locally).

Usage: python tests/oracle_compare.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from edustar.plans.catalog import oracle_sql, queries  # noqa: E402
from edustar.sources.fixtures import DRIVER_TABLES  # noqa: E402


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in DRIVER_TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return ("nan",)
        return round(v, 9)
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r))


def compare(spark, con, sf_dir: str, name: str):
    q, sql = queries()[name], oracle_sql().get(name)
    t0 = time.time()
    sdf = q(spark, sf_dir)
    srows = [tuple(r) for r in sdf.collect()]
    scols = sdf.columns
    t1 = time.time()
    if sql is None:
        return name, "no-oracle", len(srows), None, t1 - t0
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    if sorted(scols) != sorted(dcols):
        return name, f"COLUMNS spark={scols} duck={dcols}", len(srows), len(drows), t1 - t0
    if len(srows) != len(drows):
        return name, "ROWCOUNT", len(srows), len(drows), t1 - t0
    a, b = _rows(scols, srows), _rows(dcols, drows)
    if a != b:
        diff = [(x, y) for x, y in zip(a, b) if x != y][:2]
        return name, f"VALUES {diff}", len(srows), len(drows), t1 - t0
    return name, "ok", len(srows), len(drows), t1 - t0


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:] or sorted(queries())
    from edustar.session import get_session
    spark = get_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    bad = 0
    for n in names:
        try:
            r = compare(spark, con, sf_dir, n)
        except Exception as e:  # report and go on
            r = (n, f"ERROR {type(e).__name__}: {str(e)[:300]}", None, None, 0)
        bad += r[1] != "ok"
        print(f"{r[0]:32s} {r[1][:400]:10s} spark={r[2]} duck={r[3]} {r[4]:.2f}s", flush=True)
    print(f"{len(names) - bad}/{len(names)} ok")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
