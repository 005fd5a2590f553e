"""Benchmark: build the marts, then time the headline queries.

Prints ONE JSON line:
  {"metric": "total_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ..., ...}

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_RUNS (default 3), BENCH_DUCKDB (default 1: also time DuckDB on the same
analytic SQL over mart tables it builds itself, the original's serving engine).

Every query is executed in full through the ``noop`` sink, so nothing is pulled to
the driver; each number is the median of BENCH_RUNS runs after one warm-up.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "insight_absence_by_region", "insight_absence_quartiles", "corr_absence_attainment", "trendline",
    "la_cross", "attendance_enriched", "absence_trend", "absence_rank", "attendance_headline",
    "schools_enriched", "schools_by_score", "search_name", "top_k_schools", "compare_schools",
    "dq_summary", "anti_attendance_la", "screen_queries", "stg_attendance", "raw_attendance", "mart_query",
]


def _sf(sf_dir: str):
    m = re.search(r"sf([0-9.]+)", sf_dir)
    return float(m.group(1)) if m else sf_dir


def _run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def spark_bench(sf_dir: str, cpus: int, runs: int):
    from edustar.plans import catalog
    from edustar.plans.pipeline import Warehouse, _CACHE
    from edustar.session import get_session

    spark = get_session(cpus)
    spark.sparkContext.setLogLevel("ERROR")
    # build: raw mapping -> landed raw -> staging -> written marts; warm-up, then timed runs
    wh = Warehouse(spark, sf_dir).build()
    builds = []
    for _ in range(runs):
        t = time.time()
        wh.build()
        builds.append(time.time() - t)
    _CACHE[(id(spark), spark.sparkContext.applicationId, sf_dir.rstrip("/"))] = wh
    out = {"build": round(statistics.median(builds), 3)}
    for name in HEADLINE:
        q = catalog.QUERIES[name]
        _run(q(spark, sf_dir))  # warm-up
        times = []
        for _ in range(runs):
            t = time.time()
            _run(q(spark, sf_dir))
            times.append(time.time() - t)
        out[name] = round(statistics.median(times), 3)
    spark.stop()
    return out


def duckdb_bench(sf_dir: str, runs: int):
    import duckdb
    from edustar.plans import catalog
    from edustar.plans import oracle as O
    from edustar.sources.fixtures import DRIVER_TABLES

    con = duckdb.connect()
    for t in DRIVER_TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    t = time.time()
    for stmt in O.materialise_marts_sql():
        con.execute(stmt)
    out = {"build": round(time.time() - t, 3)}
    for name in HEADLINE:
        text = catalog.ORACLE.get(name)
        if text is None or not text.startswith(O.PRELUDE):
            continue
        served = "WITH" + O.SHARED + text[len(O.PRELUDE):]
        con.execute(served).fetchall()
        times = []
        for _ in range(runs):
            t = time.time()
            con.execute(served).fetchall()
            times.append(time.time() - t)
        out[name] = round(statistics.median(times), 4)
    return out


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    qs = spark_bench(sf_dir, cpus, runs)
    res = {"metric": "total_sec", "value": round(sum(qs.values()), 3), "unit": "sec", "queries": qs,
           "sf": _sf(sf_dir), "cpus": cpus, "runs": runs}
    if os.environ.get("BENCH_DUCKDB", "1") == "1":
        try:
            res["duckdb_reference_engine"] = duckdb_bench(sf_dir, runs)
        except Exception as e:  # the baseline is optional
            res["duckdb_reference_engine"] = {"error": str(e)[:200]}
    print(json.dumps(res))


if __name__ == "__main__":
    main()
