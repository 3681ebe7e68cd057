"""Publishing: a failed or dead write loses nothing; buckets save shuffles; the
master's faults are seen on the way."""

from __future__ import annotations

import contextlib
import io
import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_mod
from compare import compare, duck
from conftest import SF001
from rxreach.operators import behavior as B
from rxreach.operators import extensions as X
from rxreach.operators import hco as H
from rxreach.plans.refresh import refresh
from rxreach.sources import FIXTURES, Inputs, quality
from rxreach.sources.sink import Sink


def plan_of(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def rows(spark, path):
    return sorted(r[0] for r in spark.read.parquet(path).collect())


def test_a_write_that_fails_half_way_leaves_the_old_table(spark, tmp_path):
    out = str(tmp_path / "out")
    sink = Sink(spark, out)
    sink.publish("t", spark.range(10))
    failing = spark.range(0, 1000, 1, 8).withColumn(
        "id", F.when(F.col("id") == 900, F.raise_error(F.lit("stopped")).cast("long")).otherwise(F.col("id")))
    with pytest.raises(Exception, match="stopped"):
        sink.publish("t", failing)
    assert rows(spark, f"{out}/t") == list(range(10))
    assert os.listdir(f"{out}/_staging")                       # what had been written aside
    sink = Sink(spark, out)
    assert not os.path.exists(f"{out}/_staging") and rows(spark, f"{out}/t") == list(range(10))
    assert sorted(r[0] for r in sink.publish("t", spark.range(3)).collect()) == [0, 1, 2]
    assert rows(spark, f"{out}/t") == [0, 1, 2]


@pytest.mark.parametrize("name", ["t", "_work/t"])
def test_a_job_that_dies_between_the_renames_is_mended(spark, tmp_path, monkeypatch, name):
    out = str(tmp_path / "out")
    work = name.startswith("_work")
    Sink(spark, out).publish("t", spark.range(10), work=work)
    sink = Sink(spark, out)
    move = sink._move
    monkeypatch.setattr(sink, "_move", lambda src, dst: move(src, dst) if "_old" in dst else (_ for _ in ()).throw(OSError("dead")))
    with pytest.raises(OSError, match="dead"):
        sink.publish("t", spark.range(3), work=work)
    assert not os.path.exists(f"{out}/{name}")
    Sink(spark, out)
    assert rows(spark, f"{out}/{name}") == list(range(10))
    assert not os.path.exists(f"{out}/_old")


def test_buckets_save_the_shuffle_by_prescriber(spark, tmp_path):
    i = Inputs(spark, SF001)
    sink = Sink(spark, str(tmp_path / "out"))
    mult, _ = quality.checked_multiplicity(i.hcp_master)
    mult = sink.publish("mult", mult, work=True, by="hcp_id")
    weekly = sink.publish("weekly", H.weekly_trx(i.prescriptions), work=True, by="hcp_id")
    exposure = sink.publish("exposure", spark.range(1000).selectExpr(
        "concat('N', id % 90) as hcp_id", "cast(id % 2 as int) as calls_reach_flag", "0 as email_reach_flag",
        "0 as congress_reach_flag", "id as total_trx"), by="hcp_id")
    trx = H.as_prescriptions(weekly)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for df in (B.hcp_summary(trx, i.hcp_master, mult), B.territory_prescriber_trx(trx, i.hcp_master, mult)):
            assert "SortMergeJoin" in plan_of(df) and "Exchange" not in plan_of(df)
        # what is left is the shuffle of the small totals by their own key
        for df in (H.territory_totals(weekly, i.hcp_master, mult), X.channel_mix(exposure)):
            assert plan_of(df).count("Exchange") == 1 and "hashpartitioning(hcp_id" not in plan_of(df)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert B.hcp_summary(trx, i.hcp_master, mult).exceptAll(B.hcp_summary(i.prescriptions, i.hcp_master)).count() == 0
    sink.close()
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("rxreach_")]


MASTER = [(1, "N1"), (1, "N1"), (2, "N2"), (3, "N2"), (3, "N3"), (None, "N4"), (4, None), (None, None), (5, "N5")]


def test_master_faults_are_observed_in_the_pass_that_counts_its_rows(spark):
    master = spark.createDataFrame(MASTER, "id long, hcp_id string")
    mult, found = quality.checked_multiplicity(master)
    assert {r["hcp_id"]: r["mult"] for r in mult.collect()} == {"N1": 2, "N2": 2, "N3": 1, "N4": 1, "N5": 1, None: 2}
    assert found() == {"duplicate_hcp_id": 2, "duplicate_id": 2, "null_hcp_id": 2, "null_id": 2}
    clean, found = quality.checked_multiplicity(master.where("hcp_id = 'N5'"))
    assert clean.count() == 1 and not any(found().values())
    empty, found = quality.checked_multiplicity(master.limit(0))
    assert empty.collect() == [] and not any(found().values())


def _given(spark, tmp_path, master=None) -> dict[str, str]:
    derived, given = Inputs(spark, SF001), {}
    for name in FIXTURES:
        df = getattr(derived, name)
        if name == "hcp_master" and master is not None:
            df = master(df)
        given[name] = str(tmp_path / "in" / name)
        df.write.parquet(given[name])
    return given


def test_strict_refresh_stops_at_a_master_with_duplicates(spark, tmp_path, capfd):
    given = _given(spark, tmp_path, lambda df: df.union(df.limit(3)))
    with pytest.raises(quality.MasterError, match="'duplicate_hcp_id': 3"):
        refresh(spark, given, str(tmp_path / "out"), with_extensions=False, strict=True)
    assert not os.path.exists(tmp_path / "out" / "hcp_summary")


def test_refresh_registers_its_tables(spark, tmp_path):
    given = _given(spark, tmp_path)
    out, db = str(tmp_path / "out"), "rx_sink_test"
    spark.sql(f"CREATE DATABASE {db} LOCATION '{tmp_path}/db'")
    try:
        refresh(spark, given, out, with_extensions=False, database=db)
        con = duck(SF001)
        for key in ("omni_exposure", "territory_ranking", "dependency_risk"):
            ok, msg = compare(spark.table(f"{db}.{key}"), con, entry_mod.oracle_sql()[key])
            assert ok, f"{key}: {msg}"
        assert {"hcp_summary", "hco_base", "call_rollup"} <= {t.name for t in spark.catalog.listTables(db)}
        assert "weekly_trx" not in {t.name for t in spark.catalog.listTables(db)}
        # a later run with other columns takes the table's place
        Sink(spark, out, db).publish("call_rollup", spark.range(4).withColumnRenamed("id", "other"))
        assert spark.table(f"{db}.call_rollup").columns == ["other"] and spark.table(f"{db}.call_rollup").count() == 4
    finally:
        spark.sql(f"DROP DATABASE {db} CASCADE")
