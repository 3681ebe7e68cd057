"""Every registered query equals its independent DuckDB formulation."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry_mod
from compare import compare, duck
from conftest import SF001, SF01
from rxreach.plans.catalog import queries
from rxreach.plans.oracle import oracle_sql

KEYS = sorted(queries())


@pytest.fixture(scope="module")
def con001():
    return duck(SF001)


def test_every_query_has_an_oracle():
    assert set(queries()) == set(oracle_sql())


@pytest.mark.parametrize("key", KEYS)
def test_matches_oracle_sf0001(spark, con001, key):
    df = queries()[key](spark, SF001)
    ok, msg = compare(df, con001, oracle_sql()[key])
    assert ok, msg


@pytest.mark.parametrize("key", ["call_rollup", "email_rollup", "omni_performance",
                                 "dependency_risk", "territory_ranking"])
def test_matches_oracle_sf001(spark, key):
    df = queries()[key](spark, SF01)
    ok, msg = compare(df, duck(SF01), oracle_sql()[key])
    assert ok, msg


def test_entry_smoke(spark):
    df = entry_mod.entry(spark)
    assert df.count() > 0
    assert df.columns[:5] == ["time_granularity", "month", "year", "target_type", "channel"]


SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
                 "date": "DATE", "boolean": "BOOLEAN"}


def test_column_types_match_oracle(spark, con001):
    bad = {}
    for key, build in queries().items():
        df = build(spark, SF001)
        ours = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString())
                for f in df.schema.fields}
        rel = con001.sql(oracle_sql()[key])
        theirs = {c: str(t) for c, t in zip(rel.columns, rel.types)}
        if ours != theirs:
            bad[key] = (ours, theirs)
    assert not bad, bad
