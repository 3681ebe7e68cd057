"""Row-level joins with a hot key."""

from __future__ import annotations

from statistics import median

import pytest
from pyspark.sql import functions as F

from rxreach.functions.spread import spread_join
from rxreach.operators import behavior as B


@pytest.fixture
def even(spark):
    """No help from adaptive execution or broadcasts."""
    given = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1",
             "spark.sql.shuffle.partitions": "32"}
    before = {k: spark.conf.get(k) for k in given}
    for k, v in given.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("hot", ["'N0'", "null"])
def test_a_third_of_the_rows_on_one_prescriber(spark, even, hot):
    rows = spark.range(300_000).selectExpr(
        f"if(id % 3 = 0, {hot}, concat('N', id % 4999)) as hcp_id", "cast(id % 40 as int) as territory_id",
        "date_add(date'2024-01-01', cast(id % 700 as int)) as week", "id as trx_cnt")
    master = spark.range(5000).selectExpr("concat('N', id) as hcp_id", "concat('Tier ', id % 3) as target_type")
    out = B.trx_base(rows, master)
    sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 300_000 and len(sizes) == 32
    assert max(sizes) < 3 * median(sizes)
    want = rows.join(master.withColumnRenamed("target_type", "tier"), "hcp_id", "left").groupBy("tier").agg(F.sum("trx_cnt"), F.count("*"))
    assert sorted(out.groupBy("tier").agg(F.sum("trx_cnt"), F.count("*")).collect(), key=str) == sorted(want.collect(), key=str)


@pytest.mark.parametrize("how", ["inner", "left"])
def test_same_rows_as_the_plain_join(spark, even, how):
    facts = spark.createDataFrame([(k, i) for i, k in enumerate(["a"] * 50 + ["b", "b", None, None, "c", "d"])] + [("a", 0)] * 3, "k string, v int")
    dim = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), (None, 4), ("e", 5)], "k string, w int")
    plain = sorted(map(tuple, facts.join(dim, "k", how).collect()), key=str)
    assert sorted(map(tuple, spread_join(facts, dim, "k", how).collect()), key=str) == plain
    wrong = spark.createDataFrame([("b", 90), ("x", 1)], "k string, n long")        # a bad guess changes nothing
    assert sorted(map(tuple, spread_join(facts, dim, "k", how, wrong).collect()), key=str) == plain
    assert spread_join(facts.limit(0), dim, "k", how).count() == 0
