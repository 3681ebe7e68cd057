"""Order statistics against brute force."""

from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from rxreach.functions import ordinal
from rxreach.functions.ordinal import percentile_cont, with_rank


def brute_rank_desc_nulls_first(values):
    def key(v):
        return (0, 0) if v is None else (1, -v)
    return [1 + sum(1 for w in values if key(w) < key(v)) for v in values]


def brute_percentile(values, p):
    xs = sorted(v for v in values if v is not None)
    if not xs:
        return None
    pos = p * (len(xs) - 1)
    lo, hi = math.floor(pos), math.ceil(pos)
    return xs[lo] + (xs[hi] - xs[lo]) * (pos - lo)


@pytest.fixture(scope="module")
def values():
    rnd = random.Random(7)
    # heavy ties (one value holds a third of the rows) and some NULLs
    vals = [rnd.randint(0, 60) for _ in range(400)] + [17] * 200 + [None] * 13
    rnd.shuffle(vals)
    return vals


def test_rank_matches_brute_force(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v long") \
              .repartition(5)
    got = {r["i"]: r["rank"] for r in with_rank(df, "v", out="rank").collect()}
    want = brute_rank_desc_nulls_first(values)
    assert [got[i] for i in range(len(values))] == want


@pytest.mark.parametrize("p", [0.0, 0.25, 0.5, 0.75, 0.9, 1.0])
def test_percentile_matches_brute_force(spark, values, p):
    df = spark.createDataFrame([(v,) for v in values], "v long").repartition(4)
    got = percentile_cont(df, "v", p, out="q").collect()[0]["q"]
    assert got == pytest.approx(brute_percentile(values, p))


def test_percentile_of_empty_input_is_null(spark):
    df = spark.createDataFrame([(None,)], "v long")
    assert percentile_cont(df, "v", 0.75, out="q").collect()[0]["q"] is None


def test_percentile_agrees_with_spark_builtin(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v long")
    ours = percentile_cont(df, "v", 0.75, out="q").collect()[0]["q"]
    builtin = df.agg(F.percentile("v", 0.75).alias("q")).collect()[0]["q"]
    assert ours == pytest.approx(builtin)


@pytest.mark.parametrize("values", [
    # a million values that cluster far from one low outlier, and a long tail
    "1e12D + id * 1e-3D", "pow(2, id % 1000) + id"])
def test_ranges_hold_like_shares_however_values_cluster(spark, values):
    df = spark.range(1_000_000).selectExpr(f"{values} as v").union(spark.sql("select 0.0D as v"))
    hist = ordinal.histogram(df, "v")
    rows = ordinal.bucketed(hist, "v", ordinal.quantile_edges(hist, "v")).groupBy("_bucket").count().collect()
    mean = sum(r["count"] for r in rows) / ordinal.BUCKETS
    assert max(r["count"] for r in rows) <= 3 * mean
    lowest = ordinal.with_rank(df, "v", ascending=True, nulls_first=False).where("rank <= 2").orderBy("v").collect()
    assert [(r["v"], r["rank"]) for r in lowest][0] == (0.0, 1) and lowest[1]["rank"] == 2


@pytest.mark.parametrize("kind", ["int", "double", "decimal(12,3)", "date"])
def test_rank_of_other_types(spark, kind):
    value = "date_add(date'2024-01-01', cast(id * 7 % 50 as int))" if kind == "date" else f"cast(id * 7 % 50 - 20 as {kind})"
    df = spark.range(120).selectExpr("id", f"if(id % 11 = 0, null, {value}) as v")
    df.createOrReplaceTempView("ranked_values")
    want = spark.sql("select id, rank() over (order by v desc nulls first) as rank from ranked_values")
    assert sorted(with_rank(df, "v").select("id", "rank").collect()) == sorted(want.collect())
