"""Helpers shared by the operators: table reads, lineage cuts, components."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

WORD = r"[^\x20\x09-\x0D]+"
LINK = "src long, dst long"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def saved(df: DataFrame) -> DataFrame:
    """``df`` written as a Parquet table under the session's checkpoint folder
    (``spark.checkpoint.dir``, shared by all executors) and read back: computed
    once, lineage cut, compressed, and lost executors cost nothing."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/saved-{uuid.uuid4().hex}"
    tidy = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(tidy)
    spark.conf.set(tidy, "true")        # once written, its shuffle files are of no use
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(tidy, before)
    return spark.read.schema(df.schema).parquet(path)


def doc_key(text: str = "text") -> F.Column:
    """Second half of the row key (doc_id, _th).  Rows that agree in both are
    one document (each row gets its result); rows that share only doc_id are
    documents of their own."""
    return F.xxhash64(F.col(text)).alias("_th")


def _signature(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)).alias("n"),
                    F.sum(F.xxhash64("src", "dst").cast("decimal(38,0)")).alias("s")).first()
    return row["n"], row["s"]


def components(edges: DataFrame) -> DataFrame:
    """Connected components of undirected links (src, dst): rows
    (node, component) with component the smallest reachable node; nodes without
    a link are absent.

    Alternating large-star and small-star steps: each is a minimum per node
    (combined map-side, so a hub costs one row per task) and a join back that
    adaptive execution splits when a hub is hot.  Edges are saved each round;
    the edge set never grows, and it is a forest of stars when nothing changes.
    """
    def pairs(df, a, b):
        return (df.select(F.greatest(a, b).alias("src"), F.least(a, b).alias("dst"))
                  .where("src <> dst").distinct())

    cur = saved(pairs(edges, "src", "dst"))
    seen = _signature(cur)
    while seen[0]:
        both = cur.union(cur.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
        low = both.groupBy("src").agg(F.least("src", F.min("dst")).alias("m"))
        large = (both.where("dst > src").join(low, "src")
                     .select(F.col("dst").alias("src"), F.col("m").alias("dst")))
        large = pairs(large, "src", "dst")          # src > dst throughout
        low = large.groupBy("src").agg(F.min("dst").alias("m"))
        small = large.join(low, "src").select(
            F.explode(F.array(F.struct(F.col("dst").alias("a"), F.col("m").alias("b")),
                              F.struct(F.col("src").alias("a"), F.col("m").alias("b")))).alias("e")
        ).select("e.a", "e.b")
        cur = saved(pairs(small, "a", "b"))
        now = _signature(cur)
        if now == seen:
            break
        seen = now
    return (cur.groupBy("src").agg(F.min("dst").alias("component"))
               .select(F.col("src").alias("node"), "component")
               .union(cur.select("dst", "dst").distinct()))
