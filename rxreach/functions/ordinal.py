"""Global order statistics without funnelling unbounded data into one task.

``RANK() OVER (ORDER BY x)`` and ``PERCENTILE_CONT`` are global: written as a
plain window or as the ``percentile`` aggregate, Spark moves every row (or
every distinct value) to a single task.  Both are computed here from a
histogram of the ordered value, the same way at every size:

1. ``groupBy(x).count()``: one row per distinct value, partial-aggregated
   map-side, so a value held by a third of all rows costs nothing extra.  The
   histogram is written once (``functions/once.py``).
2. ``BUCKETS`` ranges of about equally many distinct values: their edges are
   quantiles of the histogram (``approx_percentile``).  However the values
   cluster, no range holds much more than its share.
3. Range totals (a bounded table) get their prefix sums in one window; a
   window *within* each range gives the rest.

Ranks and interpolated percentiles follow exactly from those counts: the edges
decide only which task counts what.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .once import once

BUCKETS = 256
ACCURACY = 20 * BUCKETS       # an edge is off by at most 1/20 of a range

_B = "_bucket"
_W = "_w"
BEFORE = "_before"


def _order(c: str, ascending: bool, nulls_first: bool) -> Column:
    col = F.col(c)
    if ascending:
        return col.asc_nulls_first() if nulls_first else col.asc_nulls_last()
    return col.desc_nulls_first() if nulls_first else col.desc_nulls_last()


def histogram(df: DataFrame, value: str, drop_nulls: bool = False,
              sums: tuple[str, ...] = ()) -> DataFrame:
    """Histogram (value, _w[, sum of each of ``sums``]), written once."""
    src = df.where(F.col(value).isNotNull()) if drop_nulls else df
    return once(src.groupBy(value).agg(F.count(F.lit(1)).alias(_W), *[F.sum(c).alias(c) for c in sums]))


def _before(weight: str, window: Window) -> Column:
    return F.coalesce(F.sum(weight).over(window.rowsBetween(Window.unboundedPreceding, -1)),
                      F.lit(0))


def before_col(weight: str) -> str:
    return BEFORE if weight == _W else f"{BEFORE}_{weight}"


def quantile_edges(hist: DataFrame, value: str) -> Column:
    """The ``BUCKETS - 1`` inner edges, fetched once: a literal array, so every
    use sees the same ones."""
    shares = ", ".join(str(k / BUCKETS) for k in range(1, BUCKETS))
    edges = hist.agg(F.expr(f"percentile_approx(`{value}`, array({shares}), {ACCURACY})").alias("edges")).first()["edges"]
    kind = hist.schema[value].dataType.simpleString()
    return F.expr(f"array({', '.join(f"cast('{x}' as {kind})" for x in edges or [])})")


def bucketed(hist: DataFrame, value: str, edges: Column) -> DataFrame:
    """Add the order-keeping range: how many edges are at or below the value
    (NULL for a NULL value), by halving steps over the sorted edges."""
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(BUCKETS.bit_length() - 1))])
    below = F.aggregate(steps, F.lit(0), lambda at, step: F.when(
        F.get(edges, at + step - 1) <= F.col(value), at + step).otherwise(at))
    return hist.withColumn(_B, F.when(F.col(value).isNotNull(), below))


def rows_before(hist: DataFrame, value: str, weights: tuple[str, ...] = (_W,),
                ascending: bool = True, nulls_first: bool = False) -> DataFrame:
    """Add, per weight, the total of that weight over histogram rows strictly
    earlier in the order (``_before`` for the row count, ``_before_<w>``)."""
    tagged = bucketed(hist, value, quantile_edges(hist, value))
    totals = tagged.groupBy(_B).agg(*[F.sum(c).alias(f"_bt_{c}") for c in weights])
    # at most BUCKETS + 1 rows: ordering them in one task is bounded
    by_bucket = Window.orderBy(_order(_B, ascending, nulls_first))
    offsets = totals.select(F.col(_B).alias("_ob"), *[_before(f"_bt_{c}", by_bucket).alias(f"_off_{c}")
                                                      for c in weights])
    within = Window.partitionBy(_B).orderBy(_order(value, ascending, nulls_first))
    return (tagged.join(F.broadcast(offsets), F.col(_B).eqNullSafe(F.col("_ob")))
                  .select(*hist.columns,
                          *[(F.col(f"_off_{c}") + _before(c, within)).alias(before_col(c))
                            for c in weights]))


def with_rank(df: DataFrame, value: str, out: str = "rank", ascending: bool = False,
              nulls_first: bool = True) -> DataFrame:
    """SQL ``RANK() OVER (ORDER BY value ...)`` added as column ``out`` (INT).

    Defaults follow the reference dialect for DESC: NULLs first.  ``df`` is
    read for the histogram and for the result, so give a written table.
    """
    ranks = (rows_before(histogram(df, value), value, (_W,), ascending, nulls_first)
             .select(F.col(value).alias("_rank_value"),
                     (F.col(BEFORE) + 1).cast("int").alias(out)))
    return (df.join(ranks, df[value].eqNullSafe(ranks["_rank_value"]), "inner")
              .drop("_rank_value"))


def percentile_cont(df: DataFrame, value: str, p: float, out: str = "percentile") -> DataFrame:
    """One-row frame: ``PERCENTILE_CONT(p) WITHIN GROUP (ORDER BY value)``.

    Linear interpolation between the values at 0-based positions
    floor(p*(n-1)) and ceil(p*(n-1)); NULLs ignored; NULL on empty input.
    """
    hist = histogram(df, value, drop_nulls=True)
    located = rows_before(hist, value, (_W,), ascending=True)
    n = hist.agg(F.sum(_W)).scalar()
    located = located.select(value, BEFORE, _W, ((n - 1).cast("double") * F.lit(float(p))).alias("_pos"))
    lo, hi = F.floor("_pos"), F.ceil("_pos")
    holds = lambda k: (F.col(BEFORE) <= k) & (k < F.col(BEFORE) + F.col(_W))
    picked = located.where(holds(lo) | holds(hi)).agg(
        F.max(F.when(holds(lo), F.col(value))).cast("double").alias("_lo"),
        F.max(F.when(holds(hi), F.col(value))).cast("double").alias("_hi"),
        F.max(F.col("_pos") - F.floor("_pos")).alias("_frac"))
    return picked.select(
        (F.col("_lo") + (F.col("_hi") - F.col("_lo")) * F.col("_frac")).alias(out))
