"""Side-by-side check of a Spark query against its DuckDB oracle SQL.

Order-insensitive: both results are turned into sorted lists of row tuples
(floats rounded to 9 significant digits) with columns sorted by name.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math

import duckdb

from rxreach.sources.tables import TABLES, path

EXACT = False   # set True to compare floats bit for bit


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path(sf_dir, t)}')")
    return con


def _norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, bool):
        return (1, int(v))
    if isinstance(v, float):
        if math.isnan(v):
            return (2, "nan")
        return (2, v if EXACT else float(f"{v:.9g}"))
    if isinstance(v, decimal.Decimal):
        return (2, float(f"{float(v):.9g}"))
    if isinstance(v, int):
        return (2, float(v)) if abs(v) < 2**53 else (2, v)
    if isinstance(v, dt.datetime):
        return (3, v.isoformat())
    if isinstance(v, dt.date):
        return (3, v.isoformat())
    return (4, str(v))


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_norm(r[i]) for i in order) for r in rows)


def compare(spark_df, con, sql):
    """Return (ok, message)."""
    s_cols, s_rows = rows_of(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    res = con.execute(sql)
    d_cols_raw = [d[0] for d in res.description]
    d_cols, d_rows = rows_of(d_cols_raw, res.fetchall())
    if s_cols != d_cols:
        return False, f"columns differ: spark={s_cols} duck={d_cols}"
    if len(s_rows) != len(d_rows):
        return False, f"row count differs: spark={len(s_rows)} duck={len(d_rows)}"
    bad = [(a, b) for a, b in zip(s_rows, d_rows) if a != b]
    if bad:
        return False, f"{len(bad)} rows differ, first: spark={bad[0][0]} duck={bad[0][1]}"
    return True, f"{len(s_rows)} rows equal"
