"""Command line: the whole build, like ``load`` + ``build`` of the original.

    python -m edustar.plans.run --sf-dir /root/testdata/sf0.01 [--out DIR] [--no-checks]
    python -m edustar.plans.run --register GIAS.csv --attendance ATT.csv --ks4 KS4.csv [--out DIR]

Steps: driver tables -> landed raw tables -> staging -> written marts -> the 22 data
checks (an error-level failure stops the run before the new version is published,
warnings are reported) -> the marts' serving copy -> the two insights and the headline
figures, written next to the marts. Prints one JSON line
per step with its wall time; only the small per-check summary and the per-table row
counts are brought to the driver.
"""

from __future__ import annotations

import argparse
import json
import time

from edustar.operators import insights as I
from edustar.plans.pipeline import Warehouse
from edustar.session import get_session
from edustar.sources import files


def main(argv=None) -> int:
    ap = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    ap.add_argument("--sf-dir", default=None, help="driver tables to map to the raw tables")
    ap.add_argument("--register", default=None, help="school register CSV (Latin-1)")
    ap.add_argument("--attendance", default=None, help="weekly attendance CSV (UTF-8)")
    ap.add_argument("--ks4", default=None, help="KS4 results CSV (UTF-8)")
    ap.add_argument("--out", default=None, help="root folder for tables (default: the session checkpoint dir)")
    ap.add_argument("--export", default=None, help="folder for the serving copy of the marts (default: export under the root)")
    ap.add_argument("--no-checks", action="store_true")
    ap.add_argument("--cpus", type=int, default=None)
    args = ap.parse_args(argv)
    csv_files = None
    if args.register or args.attendance or args.ks4:
        if not (args.register and args.attendance and args.ks4):
            ap.error("--register, --attendance and --ks4 go together")
        csv_files = {"raw_gias": args.register, "raw_attendance": args.attendance, "raw_ks4": args.ks4}
    elif not args.sf_dir:
        ap.error("give --sf-dir or the three CSV files")

    spark = get_session(args.cpus)
    spark.sparkContext.setLogLevel("ERROR")
    wh = Warehouse(spark, args.sf_dir or args.register, root=args.out)

    def step(name, fn):
        t = time.time()
        out = fn()
        print(json.dumps({"step": name, "sec": round(time.time() - t, 3), **(out or {})}), flush=True)

    # with checks, a version that fails one at error level is never published
    step("build", lambda: (wh.build(csv_files, check=not args.no_checks), None)[1])
    step("load_counts", lambda: {r["table_name"]: r["n_rows"] for r in files.load_counts(wh.metrics).collect()})
    if not args.no_checks:
        def report():
            summary = wh.checked().collect()
            return {"checks": len(summary), "not_passing": [r.asDict() for r in summary if r["status"] != "pass"]}
        step("checks", report)
    step("export_marts", lambda: {r["table_name"]: [r["n_rows"], r["digest"]] for r in files.export_marts(
        {n: wh.mart(n) for n in wh.MARTS}, args.export or f"{wh.root}/export").collect()})

    a, k, d = wh.attendance, wh.ks4, wh.dim
    outputs = {
        "insight_absence_by_region": I.insight_absence_by_region(a, d),
        "insight_absence_quartiles": I.insight_absence_quartiles(a, k, d),
        "la_cross": I.la_cross(a, k, d),
        "corr_absence_attainment": I.corr_absence_attainment(I.la_cross(a, k, d)),
        "national_absence": I.national_absence(a),
        "attainment_spread": I.attainment_spread(k, d),
    }
    for name, df in outputs.items():
        step(name, lambda df=df, name=name: (df.write.mode("overwrite").parquet(f"{wh.root}/insights/{name}"), None)[1])
    print(json.dumps({"step": "done", "root": wh.root}))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
