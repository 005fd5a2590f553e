"""Write the physical plans of the headline queries to a markdown file.

    python -m edustar.plans.explain --sf-dir /root/testdata/sf0.1 --out PLANS.md

Each query is collected once first, through the frame's own query execution, so the
adaptive plan shown is the final one AQE chose on measured sizes; the scan lines (``PushedFilters``,
``ReadSchema``) are listed under each tree.
"""

from __future__ import annotations

import argparse

from edustar.plans import catalog
from edustar.session import get_session

HEADLINE = [
    "insight_absence_by_region", "insight_absence_quartiles", "la_cross", "corr_absence_attainment",
    "filter_view", "absence_trend", "schools_by_score", "compare_schools", "top_k_schools",
    "dq_summary", "anti_ks4_urn", "filter_options", "screen_queries", "raw_attendance_mapping", "raw_ks4_mapping",
]


def _plan(spark, df) -> str:
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return df._jdf.queryExecution().explainString(mode)


def main(argv=None) -> int:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf-dir", default="/root/testdata/sf0.1")
    ap.add_argument("--out", default="PLANS.md")
    args = ap.parse_args(argv)
    spark = get_session()
    spark.sparkContext.setLogLevel("ERROR")
    from edustar.sources.fixtures import raw_attendance, raw_ks4
    extra = {"raw_attendance_mapping": lambda s, d: raw_attendance(s, d),
             "raw_ks4_mapping": lambda s, d: raw_ks4(s, d)}
    lines = ["# Physical plans", "",
             f"Final adaptive plans at `{args.sf_dir}` (session of `edustar.session.get_session`), "
             "generated by `python -m edustar.plans.explain`.", ""]
    for name in HEADLINE:
        fn = extra.get(name) or catalog.QUERIES[name]
        df = fn(spark, args.sf_dir)
        df.collect()  # through the frame's own execution, so the plan below is AQE's final one
        plan = _plan(spark, df)
        tree = plan.split("\n\n")[0]
        scans = [ln for ln in plan.splitlines() if ln.startswith(("PushedFilters", "ReadSchema"))]
        lines += [f"## {name}", "", "```", tree.strip(), "", *scans, "```", ""]
    with open(args.out, "w") as fh:
        fh.write("\n".join(lines))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
