"""Hand-built inputs: the same frames in Spark and in DuckDB.

Each case is written to Parquet once (so both engines see identical types)
and then read by Spark and registered as a DuckDB view under the input name.
"""

from __future__ import annotations

import os
import types

import duckdb

from compare import compare
from rxreach.plans import catalog
from rxreach.plans.oracle import oracle_sql
from rxreach.sources.schemas import SCHEMAS


def schema(name):
    return SCHEMAS[name]


class _Frames(types.SimpleNamespace):
    """The eight inputs as attributes, plus the memo hook catalog builders use."""

    def memo(self, key, build):
        store = self.__dict__.setdefault("_memo", {})
        if key not in store:
            store[key] = build()
        return store[key]


class Case:
    """Inputs for one test: missing tables are empty."""

    def __init__(self, spark, tmp_path, **rows):
        self.con = duckdb.connect()
        frames = {}
        for name in SCHEMAS:
            df = spark.createDataFrame(rows.get(name, []), schema(name))
            p = os.path.join(str(tmp_path), name)
            df.coalesce(1).write.mode("overwrite").parquet(p)
            frames[name] = spark.read.parquet(p)
            self.con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{p}/*.parquet')")
        self.inputs = _Frames(**frames)

    def spark_df(self, key):
        return catalog.BUILDERS[key](self.inputs)

    def rows(self, key):
        return [r.asDict() for r in self.spark_df(key).collect()]

    def check(self, key):
        ok, msg = compare(self.spark_df(key), self.con, oracle_sql(with_fixtures=False)[key])
        assert ok, f"{key}: {msg}"
