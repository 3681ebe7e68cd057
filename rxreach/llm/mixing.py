"""Mixing sources to target weights by capped water-filling [native].

Sources, by code point with null last, weigh 1, 2, 3, 1, 2, 3, ... and share
the words of the whole corpus.  A source's target stops at ``max_epochs`` times
its size; what it can't take is shared by weight among the rest until no source
is above its cap.  That fixed point is the water level L for which
``sum(min(cap, weight * L))`` is the total, found in one pass over the sources
ordered by cap / weight.

Each source then takes ``floor(target / size)`` whole repetitions of every
document, and one more of a seeded part: documents fall by hash into
``BUCKETS`` (4096) buckets per source, buckets below a cut repeat whole, and the
documents of the one bucket on the cut repeat their leading share of words, so
a source's taken words differ from its target by rounding alone.  A bucket's
sum is combined map-side, and documents meet their source's plan in ``SALTS``
parts by bucket; no source is ever gathered in one task.

Cases: null text and text without words have size 0 and take 0; null is a
source of its own; a source of size 0 has target 0; no rows give no rows; equal
rows are separate rows with equal hashes; extra columns are ignored.  A null
doc_id hashes like any value.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD

BUCKETS = 4096
SALTS = 64           # parts of a source when its plan meets its documents


def targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), max_epochs: int = 3) -> DataFrame:
    """(source, source_size) -> + weight, target.  One row per source; the
    windows run over that aggregate only."""
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    at = F.array(*[F.lit(w) for w in weights])
    s = sizes.withColumn("weight", F.get(at, (rank - 1) % len(weights)).cast("long"))
    s = s.withColumn("cap", F.col("source_size") * max_epochs)
    order = Window.orderBy((F.col("cap") / F.col("weight")).asc(), F.col("source").asc_nulls_last())
    whole = Window.partitionBy()
    s = (s.withColumn("cap_before", F.coalesce(F.sum("cap").over(
            order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
          .withColumn("weight_left", F.sum("weight").over(
              order.rowsBetween(0, Window.unboundedFollowing)))
          .withColumn("total", F.sum("source_size").over(whole)))
    # the level if this source and all after it in the order stay below their caps
    level = (F.col("total") - F.col("cap_before")).cast("double") / F.col("weight_left")
    s = s.withColumn("level", level)
    free = F.col("cap").cast("double") > F.col("level") * F.col("weight")
    s = s.withColumn("water", F.first(F.when(free, F.col("level")), ignorenulls=True).over(
        order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    return s.select("source", "source_size", "weight", F.when(
        F.col("water").isNull(), F.col("cap").cast("double")).otherwise(
        F.least(F.col("cap").cast("double"), F.col("water") * F.col("weight"))).alias("target"))


def mix(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), max_epochs: int = 3,
        seed: int = 17) -> DataFrame:
    """``docs`` (doc_id, text, source) -> doc_id, source, size, source_size,
    target, taken (words, repeats counted) and repeats (taken / size)."""
    d = docs.select(
        "doc_id", "source",
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        # the first 12 bits of a hash of seed and id
        F.conv(F.left(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))),
                      F.lit(3)), 16, 10).cast("int").alias("bucket"))
    buckets = d.groupBy("source", "bucket").agg(F.sum("size").alias("words"))
    goals = targets(buckets.groupBy("source").agg(F.sum("words").alias("source_size")), weights, max_epochs)
    ratio = F.col("target") / F.col("source_size")
    goals = (goals.withColumn("whole", F.when(F.col("source_size") > 0, F.floor(ratio)).otherwise(0).cast("long"))
                  .withColumn("more", F.col("target") - F.col("whole") * F.col("source_size"))
                  .select(F.col("source").alias("g_source"), "source_size", "target", "whole", "more"))
    # at most BUCKETS rows a source: words of its buckets up to each one
    run = Window.partitionBy("source").orderBy("bucket")
    cuts = (buckets.withColumn("upto", F.sum("words").over(run))
                   .join(goals, F.col("source").eqNullSafe(F.col("g_source")))
                   .where(F.col("upto") > F.col("more"))
                   .groupBy("g_source").agg(F.min(F.struct("bucket", "words", "upto")).alias("cut")))
    plan = (goals.join(cuts.withColumnRenamed("g_source", "c_source"),
                       F.col("g_source").eqNullSafe(F.col("c_source")), "left")
                 .select("g_source", "source_size", "target", "whole",
                         F.coalesce("cut.bucket", F.lit(BUCKETS)).alias("cut"),
                         # share of the cut bucket's words that is taken once more
                         F.coalesce((F.col("more") - F.col("cut.upto") + F.col("cut.words"))
                                    / F.col("cut.words"), F.lit(0.0)).alias("share")))
    plan = plan.withColumn("g_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    out = d.join(plan, F.col("source").eqNullSafe(F.col("g_source")) & (F.col("bucket") % SALTS == F.col("g_salt")))
    extra = (F.when(F.col("bucket") < F.col("cut"), F.col("size"))
              .when(F.col("bucket") == F.col("cut"), F.floor(F.col("share") * F.col("size") + 0.5).cast("long"))
              .otherwise(0))
    out = out.withColumn("taken", F.col("whole") * F.col("size") + extra)
    return out.select("doc_id", "source", "size", "source_size", "target", "taken",
                      F.when(F.col("size") > 0, F.col("taken") / F.col("size")).otherwise(0.0).alias("repeats"))
