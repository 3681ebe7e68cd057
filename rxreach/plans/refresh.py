"""Full refresh: every output table, written in dependency order.

This is the batch job a user runs (the reference's chain of
``CREATE OR REPLACE TABLE ... AS``).  Each table is written aside and then put
in place as ``out_dir/<name>`` (``sources/sink.py``); the tables that are asked
by prescriber again and again (weekly TRx, master rows per prescriber, L1
exposure) are bucketed by it.  Tables that later tables read (L1 exposure, HCP
summary and behaviour, HCO summary, high-value HCOs) are read back from what
was written, which both reuses them and cuts their lineage — a lost executor
later in the run recomputes from those files, not from the raw inputs.  The
eight inputs are derived once, into ``out_dir/_work``, before anything else.
``out_dir`` must be a shared folder (HDFS, object store) on a cluster.

Inputs are either the driver's test tables (``--sf-dir``, the fixture
derivation of ``sources/fixtures.py``) or the user's own eight tables
(``--inputs name=path_or_table,...``, conformed by ``sources/schemas.py``).
With ``--database`` each output is also registered as a catalog table
``<database>.<name>`` over the written files.

CLI::

    python -m rxreach.plans.refresh --sf-dir /root/testdata/sf0.1 --out /shared/omni
    python -m rxreach.plans.refresh --inputs calls=/lake/calls,...,hcp_master=crm.hcp --out /shared/omni
"""

from __future__ import annotations

import argparse
import json
import sys
import time
import types

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import behavior as B
from ..operators import channels as C
from ..operators import extensions as X
from ..operators import hco as H
from ..operators import omni as O
from ..sources import FIXTURES, Inputs, TableInputs, quality
from ..sources.sink import Sink


def refresh(spark: SparkSession, source: str | dict[str, str], out_dir: str,
            with_extensions: bool = True, database: str | None = None,
            strict: bool = False) -> dict[str, float]:
    """Write all tables; return seconds per table.

    Duplicate or missing ids of the master are reported on stderr, or raise
    before any table is built (``strict``).

    ``source``: a test-data folder, or ``{input name: parquet path or table}``.
    """
    timings: dict[str, float] = {}

    sink = Sink(spark, out_dir, database)

    def publish(name: str, df: DataFrame, work: bool = False, by: str | None = None) -> DataFrame:
        t0 = time.perf_counter()
        written = sink.publish(name, df, work, by)
        timings[name] = round(time.perf_counter() - t0, 3)
        return written

    # the eight inputs are derived (or conformed) once; every table is built from the files
    given = TableInputs(spark, source) if isinstance(source, dict) else Inputs(spark, source)
    i = types.SimpleNamespace(**{name: publish(f"input_{name}", getattr(given, name), work=True)
                                 for name in FIXTURES})
    # master rows per prescriber: every later table joins these, and they show duplicate ids
    mult, found = quality.checked_multiplicity(i.hcp_master)
    mult = publish("master_multiplicity", mult, work=True, by="hcp_id")
    if any(found().values()):
        if strict:
            raise quality.MasterError(found())
        print(f"hcp_master: {found()}", file=sys.stderr)

    # L1 channel rollups
    publish("call_rollup", C.call_rollup(i.calls))
    publish("email_rollup", C.email_rollup(i.emails))
    publish("congress_rollup", C.congress_rollup(i.congress))
    publish("paid_search_rollup", C.paid_search_rollup(i.paid_search))
    publish("display_rollup", C.display_rollup(i.display))
    publish("website_rollup", C.website_rollup(i.website))
    publish("trx_rollup", C.trx_rollup(i.prescriptions))

    # prescriptions once per (prescriber, territory, week): all tables below but the
    # row-level bases come from it
    weekly = publish("weekly_trx", H.weekly_trx(i.prescriptions), work=True, by="hcp_id")
    trx = H.as_prescriptions(weekly)
    # rows per prescriber (those without a TRx value aside): which of them are hot
    counts = weekly.groupBy("hcp_id").agg(F.sum("_n").alias("n"))

    # omni L1 -> L2
    exposure = publish("omni_exposure", O.omni_exposure(
        i.calls, i.emails, i.congress, trx, i.hcp_master), by="hcp_id")
    publish("omni_performance", O.omni_performance(exposure))

    # prescriber behaviour
    publish("hcp_writing_analysis", B.hcp_writing_analysis(trx, i.hcp_master))
    publish("trx_base", B.trx_base(i.prescriptions, i.hcp_master, counts))
    summary = publish("hcp_summary", B.hcp_summary(trx, i.hcp_master, mult))
    publish("monthly_active_hcps", B.monthly_active_hcps(trx))
    publish("cohort_analysis", B.cohort_analysis(summary))
    behavior = publish("hcp_behavior", B.hcp_behavior(summary, i.hcp_master))
    publish("tier_behavior_matrix", B.tier_behavior_matrix(behavior))
    publish("territory_ranking", B.territory_ranking(trx, i.hcp_master, mult))
    publish("growth_funnel", B.growth_funnel(summary))

    # HCO and dependency
    publish("hco_base", H.hco_base(i.prescriptions, i.hcp_master, mult, counts))
    affiliated = publish("affiliated_trx", H.affiliated_trx(weekly, i.hcp_master, mult), work=True)
    hco_sum = publish("hco_summary", H.hco_summary(affiliated))
    high_value = publish("high_value_hco", H.high_value_hco(hco_sum))
    publish("hco_concentration", H.hco_concentration(high_value))
    publish("high_value_hco_territory", H.high_value_hco_territory(affiliated, high_value))
    publish("dependency_risk", H.dependency_risk(
        H.territory_high_value_trx(affiliated, high_value),
        H.territory_totals(weekly, i.hcp_master, mult)))

    if with_extensions:
        for name, build in X.from_tables(trx, exposure, summary, affiliated).items():
            publish(name, build())
    sink.close()
    return timings


def main() -> None:
    from ..session import build_session
    ap = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    src = ap.add_mutually_exclusive_group(required=True)
    src.add_argument("--sf-dir", help="folder of the driver's test tables")
    src.add_argument("--inputs", help="name=path_or_table,... for all eight inputs")
    ap.add_argument("--out", required=True, help="shared output folder")
    ap.add_argument("--database", default=None, help="also register outputs as catalog tables")
    ap.add_argument("--master", default=None)
    ap.add_argument("--shuffle-partitions", type=int, default=None,
                    help="default: what the launcher configured")
    ap.add_argument("--no-extensions", action="store_true")
    ap.add_argument("--strict", action="store_true", help="stop if the master has duplicate or missing ids")
    a = ap.parse_args()
    source = a.sf_dir or dict(kv.split("=", 1) for kv in a.inputs.split(","))
    spark = build_session(a.master, a.shuffle_partitions)
    print(json.dumps(refresh(spark, source, a.out, not a.no_extensions, a.database, a.strict)))


if __name__ == "__main__":
    main()
