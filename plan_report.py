"""Plan shape of every query: ours vs the literal SQL form, from ``explain``.

Counts, in the initial physical plan (before AQE re-planning), the Parquet
scans, shuffle exchanges, broadcast exchanges and Expand nodes, and checks
that every scan reads a pruned schema.
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from rxreach.plans import catalog  # noqa: E402
from rxreach.session import build_session  # noqa: E402


def shape(df) -> dict[str, int]:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    plan = buf.getvalue()
    scans = re.findall(r"FileScan parquet \S*\[(.*?)\]", plan)
    return {
        "scans": len(scans),
        "shuffles": len(re.findall(r"Exchange (hashpartitioning|rangepartitioning|SinglePartition)", plan)),
        "broadcasts": plan.count("BroadcastExchange"),
        "expands": len(re.findall(r"\bExpand\b", plan)),
        "max_scan_cols": max((len(s.split(",")) for s in scans), default=0),
    }


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]")
    lines = [
        "# PLANS — physical plan shape per query",
        "",
        f"Generated by `plan_report.py` on `{sf_dir}`: the whole plan of each query before AQE, scalar",
        "subqueries included.  AQE reuses equal exchanges, so a scan listed several times runs once.",
        "`jobs` = Spark jobs run while the query is built (measured).  `cols` = most columns any scan reads.",
        "",
        "| query | scans | shuffles | broadcasts | Expand | cols | jobs |",
        "|---|---|---|---|---|---|---|",
    ]
    tracker = spark.sparkContext.statusTracker()
    for key in catalog.BUILDERS:
        spark.sparkContext.setJobGroup(key, key)
        df = catalog.build(spark, sf_dir, key)
        jobs = len(tracker.getJobIdsForGroup(key))
        o = shape(df)
        lines.append(f"| `{key}` | {o['scans']} | {o['shuffles']} | {o['broadcasts']} | {o['expands']} | "
                     f"{o['max_scan_cols']} | {jobs} |")
        print(lines[-1], flush=True)
    with open(os.path.join(os.path.dirname(os.path.abspath(__file__)), "PLANS.md"), "w") as f:
        f.write("\n".join(lines) + "\n")
    spark.stop()


if __name__ == "__main__":
    main()
