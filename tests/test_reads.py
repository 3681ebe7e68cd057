"""How often each query reads the raw tables, from Spark's event log of an
executed run (adaptive re-planning and reused exchanges included)."""

from __future__ import annotations

import glob
import json
import os
import subprocess
import sys

import pytest

from conftest import ROOT, SF001

# every query on the prescriptions, and how often it may read them
ONCE = ["hcp_summary", "territory_ranking", "hco_summary", "hco_value_cutoff", "high_value_hco", "hco_concentration",
        "high_value_hco_territory", "territory_high_value_trx", "territory_totals", "dependency_risk",
        "churn_indicators", "hco_growth_segment", "hco_adoption", "hcp_concentration", "opportunity_territories",
        "omni_performance", "engagement_trx_correlation", "channel_effectiveness"]

RUN = """
import sys; sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "4").config("spark.sql.session.timeZone", "UTC")
         .config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", "file://{log}")
         .config("spark.eventLog.rolling.enabled", "false").config("spark.eventLog.compress", "false").getOrCreate())
spark.sparkContext.setCheckpointDir("file://{log}-ckpt")
from rxreach.plans import catalog
for key in {keys!r}:
    spark.sparkContext.setLocalProperty("key", key)
    catalog.build(spark, {sf!r}, key).write.format("noop").mode("overwrite").save()
spark.stop()
"""


def _scans(node: dict) -> list[dict]:
    own = [node] if node["nodeName"].startswith("Scan parquet") else []
    return own + [s for c in node["children"] for s in _scans(c)]


@pytest.fixture(scope="module")
def reads(tmp_path_factory):
    """{query: {raw table: rows read}}"""
    log = str(tmp_path_factory.mktemp("events"))
    code = RUN.format(root=ROOT, log=log, keys=ONCE, sf=SF001)
    subprocess.run([sys.executable, "-c", code], check=True, timeout=900, capture_output=True)
    table_of, key_of_stage, seen = {}, {}, {}
    for line in open(glob.glob(f"{log}/*")[0]):
        e = json.loads(line)
        plan = e.get("sparkPlanInfo")
        if plan:
            for scan in _scans(plan):
                name = os.path.basename(scan["metadata"].get("Location", "").split("[")[-1].rstrip("]"))
                for m in scan["metrics"]:
                    if m["name"] == "number of output rows":
                        table_of[m["accumulatorId"]] = name
        elif e["Event"] == "SparkListenerJobStart":
            for s in e["Stage IDs"]:
                key_of_stage[s] = e["Properties"].get("key")
        elif e["Event"] == "SparkListenerStageCompleted":
            info = e["Stage Info"]
            for a in info["Accumulables"]:
                if a["ID"] in table_of:
                    rows = seen.setdefault(key_of_stage[info["Stage ID"]], {})
                    rows[a["ID"]] = max(rows.get(a["ID"], 0), int(a["Value"]))
    out: dict = {}
    for key, rows in seen.items():
        for i, n in rows.items():
            out.setdefault(key, {}).setdefault(table_of[i], 0)
            out[key][table_of[i]] += n
    return out


@pytest.mark.parametrize("key", ONCE)
def test_prescriptions_are_read_once(spark, reads, key):
    rows = spark.read.parquet(f"{SF001}/lineitem.parquet").count()
    assert reads[key]["lineitem.parquet"] == rows
