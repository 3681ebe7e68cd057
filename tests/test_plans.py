"""Plan properties that matter at scale, asserted on every query's physical plan."""

from __future__ import annotations

import contextlib
import io
import re

import pytest

from rxreach.plans.catalog import BUILDERS, queries
from conftest import SF001

KEYS = sorted(BUILDERS)


def plan_of(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.fixture(scope="module")
def plans(spark):
    return {k: plan_of(f(spark, SF001)) for k, f in queries().items()}


@pytest.mark.parametrize("key", KEYS)
def test_no_python_udf_no_cartesian(plans, key):
    plan = plans[key]
    for bad in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct",
                "BroadcastNestedLoopJoin", "FlatMapGroupsInPandas", "MapInPandas"):
        assert bad not in plan, f"{key}: {bad}"


@pytest.mark.parametrize("key", KEYS)
def test_scans_are_pruned(plans, key):
    scans = re.findall(r"Location: \w+ \[(.*?)\]\n.*?ReadSchema: struct<(.*?)>", plans[key], re.S)
    assert scans
    for at, schema in scans:
        # a derived table that the query wrote holds what its rows show and no more
        assert "/once-" in at or schema.count(":") <= 5, f"{key} reads {schema}"


def test_status_filter_reaches_parquet(plans):
    assert "PushedFilters: [IsNotNull(o_orderstatus), EqualTo(o_orderstatus,O)" in plans["email_rollup"]


@pytest.mark.parametrize("key", ["call_rollup", "email_rollup", "congress_rollup", "trx_rollup",
                                 "omni_performance"])
def test_rollups_expand_once(plans, key):
    assert len(re.findall(r"\) Expand\b", plans[key])) == 1, key


def test_flagship_has_no_global_window(plans):
    # windows without PARTITION BY run on one task; the flagship must have none
    assert "Window" not in plans["omni_performance"]


# these need a derived table more than once and write it while they are built
WRITES_FIRST = {"trx_base", "hco_base", "territory_ranking", "hco_value_cutoff", "high_value_hco", "hco_concentration",
                "high_value_hco_territory", "territory_high_value_trx", "dependency_risk",
                "churn_indicators", "hco_growth_segment", "opportunity_territories", "hcp_concentration"}


@pytest.mark.parametrize("key", sorted(set(KEYS) - WRITES_FIRST))
def test_building_runs_no_job(spark, key):
    sc = spark.sparkContext
    sc.setJobGroup(f"build-{key}", key)
    try:
        queries()[key](spark, SF001)
        assert not sc.statusTracker().getJobIdsForGroup(f"build-{key}")
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)


def test_a_grown_folder_is_read_whole(spark, tmp_path):
    from rxreach.sources import tables
    spark.range(10).write.parquet(str(tmp_path / "t.parquet"))
    assert tables.read(spark, str(tmp_path), "t").count() == 10
    spark.range(5).write.mode("append").parquet(str(tmp_path / "t.parquet"))
    assert tables.read(spark, str(tmp_path), "t").count() == 15


def test_configured_shuffle_partitions_survive(spark):
    from rxreach.session import build_session
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "400")
    try:
        assert build_session().conf.get("spark.sql.shuffle.partitions") == "400"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_inputs_keep_every_row(spark):
    from rxreach.sources import Inputs, tables
    i = Inputs(spark, SF001)
    for name, table in (("hcp_master", "customer"), ("prescriptions", "lineitem"), ("display", "events")):
        assert getattr(i, name).count() == spark.read.parquet(tables.path(SF001, table)).count()


def test_reach_flags_travel_in_one_column(spark):
    from rxreach.plans import catalog
    plan = catalog.build(spark, "/root/testdata/sf0.001", "omni_performance")._jdf.queryExecution().optimizedPlan().toString()
    assert "_flags0" in plan and "max(CASE" not in plan
