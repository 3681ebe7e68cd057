"""Benchmark: every registered query over the whole tables of one scale factor.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_REPEAT (default 1; the literal-compared keys always get at least 2
interleaved runs and report the best), BENCH_LITERAL
(default 1: also time the literal form of the headline queries — UNION of one
SELECT per level for the rollups, ``rxreach/plans/literal.py`` for the others —
interleaved with ours so JVM warm-up favours neither).  Each query is executed
completely with the ``noop`` sink (no collect).  Prints ONE JSON line; the
metric is the sum over all registered queries.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from rxreach.plans import catalog  # noqa: E402
from rxreach.plans.oracle import oracle_sql  # noqa: E402
from rxreach.plans.literal import LITERAL  # noqa: E402
from rxreach.session import build_session  # noqa: E402
from rxreach.sources import Inputs  # noqa: E402
from rxreach.sources.tables import TABLES, path  # noqa: E402

# the headline queries whose literal form (one SELECT per step) is timed beside ours
LITERAL_KEYS = ["call_rollup", "email_rollup", "congress_rollup", "trx_rollup",
                "paid_search_rollup", "display_rollup", "website_rollup", *LITERAL]


def _run(df) -> float:
    t = time.perf_counter()
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    literal = os.environ.get("BENCH_LITERAL", "1") == "1"
    repeat = max(1, int(os.environ.get("BENCH_REPEAT", "1")))
    spark = build_session(f"local[{cpus}]")
    if literal:
        for t in TABLES:
            spark.read.parquet(path(sf_dir, t)).createOrReplaceTempView(t)
    sqls = oracle_sql()

    def ours(key: str) -> float:
        t0 = time.perf_counter()
        df = catalog.build(spark, sf_dir, key)
        return time.perf_counter() - t0 + _run(df)

    def literal_form(key: str) -> float:
        t0 = time.perf_counter()
        # building (or parsing) and analysis, as ours includes building
        df = LITERAL[key](Inputs(spark, sf_dir)) if key in LITERAL else spark.sql(sqls[key])
        return time.perf_counter() - t0 + _run(df)

    # warm-up: JVM class loading and codegen caches, not timed
    for key in ("trx_week_bounds", "email_rollup", "hcp_summary"):
        ours(key)

    times: dict[str, float] = {}
    lit: dict[str, float] = {}
    for key in catalog.BUILDERS:
        runs, lruns = [], []
        compared = literal and key in LITERAL_KEYS
        for _ in range(max(repeat, 2) if compared else repeat):
            runs.append(ours(key))
            if compared:
                lruns.append(literal_form(key))
        times[key] = round(min(runs), 3)
        if lruns:
            lit[key] = round(min(lruns), 3)

    out = {
        "metric": "all_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "cpus": int(cpus),
    }
    if lit:
        out["literal_form"] = lit
        out["speedup_vs_literal"] = {k: round(lit[k] / times[k], 2) for k in lit}
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
