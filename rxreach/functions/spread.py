"""Row-level joins whose hot keys are split before the shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .once import once

SHARE = 4        # a piece of a hot key is at most this part of an even partition


def spread_join(facts: DataFrame, dim: DataFrame, key: str, how: str = "inner",
                counts: DataFrame | None = None) -> DataFrame:
    """``facts`` joined to the small side ``dim`` on ``key`` (``inner`` or ``left``).

    With P shuffle partitions, a key with over 1/(4 P) of all fact rows is hot:
    there are at most 4 P of those, whatever the data, so their table is
    broadcast.  A hot key's facts are dealt over as many pieces as it has such
    shares, by a hash of the row, and its few ``dim`` rows are repeated for each
    piece; other keys have one.  So no task gets much more than an even part,
    with or without adaptive execution.  Fact rows that agree in every column
    stay together.  A NULL key matches nothing, but its rows are dealt alike.

    ``counts`` (key, n): rows per key where the caller knows them (a good guess
    will do: the result doesn't depend on them); else they are counted first.
    """
    pieces = SHARE * int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if counts is None:
        counts = once(facts.groupBy(key).agg(F.count(F.lit(1)).alias("n")))
    total = counts.agg(F.sum("n")).scalar()
    hot = F.broadcast(counts.where(F.col("n") * pieces > total).select(
        F.col(key).alias("_hot"), F.ceil(F.col("n") * pieces / total).alias("_pieces")))
    salt = F.coalesce(F.pmod(F.xxhash64(*facts.columns), F.col("_pieces")), F.lit(0)).alias("_salt")
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce(F.col("_pieces"), F.lit(1)) - 1)).alias("_salt")
    left = facts.join(hot, F.col(key).eqNullSafe(F.col("_hot")), "left").select(*facts.columns, salt)
    right = dim.join(hot, F.col(key).eqNullSafe(F.col("_hot")), "left").select(*dim.columns, every)
    return left.join(right, [key, "_salt"], how).drop("_salt")
