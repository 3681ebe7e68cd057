"""Parquet scans of the driver's tables.

Every read names the columns it needs, so the scan's ``ReadSchema`` holds only
those and filters placed above it reach the Parquet reader as
``PushedFilters``.  The types of those columns are given, so building a query
runs no job; nothing is kept between reads, so a folder that has grown is read
whole.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")

TYPES = {
    "customer": {"c_custkey": "bigint", "c_nationkey": "int", "c_mktsegment": "string"},
    "orders": {"o_orderkey": "bigint", "o_custkey": "bigint", "o_orderstatus": "string",
               "o_orderdate": "timestamp_ntz", "o_orderpriority": "string"},
    "lineitem": {"l_orderkey": "bigint", "l_quantity": "double", "l_returnflag": "string",
                 "l_shipdate": "timestamp_ntz"},
    "events": {"event_id": "bigint", "user_id": "bigint", "value": "double"},
}


def path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read(spark: SparkSession, sf_dir: str, name: str,
         columns: tuple[str, ...] | list[str] | None = None) -> DataFrame:
    known = TYPES.get(name, {})
    if columns and all(c in known for c in columns):
        schema = ", ".join(f"{c} {known[c]}" for c in columns)
        return spark.read.schema(schema).parquet(path(sf_dir, name))
    df = spark.read.parquet(path(sf_dir, name))
    return df.select(*columns) if columns else df
