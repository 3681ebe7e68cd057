"""Labelled multi-level rollups: one grouping-sets aggregate instead of a
UNION ALL of one GROUP BY per level.

The reference writes every rollup level as its own SELECT ... GROUP BY and
glues them with UNION ALL, which scans and shuffles the input once per level.
Here all levels are one ``groupingSets`` aggregate: Spark expands each input
row once per set inside the map task, combines partially before the shuffle,
and finishes in one exchange.  ``grouping_id`` tells the levels apart, so a
NULL dimension value (its own group) never mixes with a rolled-up level.

Distinct counts (``COUNT(DISTINCT CASE WHEN cond THEN entity END)``) are done
in two aggregates: first per (level keys, entity) with max(cond) flags, then
the flags are summed per level.  That needs one extra small shuffle but no
second Expand per distinct expression, and it stays skew-safe: the first step
is keyed by the entity, the second step combines map-side.  The flags of an
entity travel as the bits of one long: as columns of their own they would be
over half of each row that the first step holds in memory and shuffles.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

GID = "_gid"


def rolled(dims: Sequence[str], dim: str, gid: str = GID) -> Column:
    """True on rows of a level where ``dim`` is rolled up (not a group key).

    ``grouping_id`` puts the first grouping column in the highest bit.
    """
    shift = len(dims) - 1 - list(dims).index(dim)
    return F.shiftright(F.col(gid), shift).bitwiseAND(F.lit(1)) == 1


def grouping_sets(df: DataFrame, dims: Sequence[str], sets: Sequence[Sequence[str]],
                  aggs: Sequence[Column]) -> DataFrame:
    """All levels in one aggregate; adds ``_gid`` (bit set = rolled up)."""
    return (df.groupingSets([list(s) for s in sets], *dims)
              .agg(F.grouping_id().alias(GID), *aggs))


def grouping_sets_with_reach(df: DataFrame, dims: Sequence[str],
                             sets: Sequence[Sequence[str]], entity: str,
                             additive: Mapping[str, Column],
                             reach: Mapping[str, Column]) -> DataFrame:
    """Grouping sets with additive measures and distinct-entity counts.

    ``additive``: name -> aggregate expression whose per-entity partials can
    be summed (COUNT, COUNT_IF, SUM).  ``reach``: name -> boolean row
    condition; the result is the number of distinct non-NULL ``entity``
    values with at least one row meeting it in the level.
    Returns ``_gid``, the ``dims`` (NULL where rolled up) and the measures.
    """
    keys, conds = list(dims) + [entity], list(reach.values())
    # 63 flags to a long; the sign is left alone
    bits = [reduce(Column.bitwiseOR, [F.when(cond, F.lit(1 << k)).otherwise(F.lit(0)).cast("bigint")
                                      for k, cond in enumerate(conds[at:at + 63])])
            for at in range(0, len(conds), 63)]
    per_entity = (df.groupingSets([list(s) + [entity] for s in sets], *keys)
                    # the entity is the last, never rolled-up key: drop its bit
                    .agg(F.shiftright(F.grouping_id(), 1).alias(GID),
                         *[agg.alias(n) for n, agg in additive.items()],
                         *[F.bit_or(b).alias(f"_flags{k}") for k, b in enumerate(bits)]))
    has_entity = F.col(entity).isNotNull()
    return (per_entity.groupBy(GID, *dims)
            .agg(*[F.sum(n).alias(n) for n in additive],
                 *[F.sum(F.when(has_entity, F.shiftright(f"_flags{k // 63}", k % 63).bitwiseAND(F.lit(1))).otherwise(F.lit(0)))
                    .cast("bigint").alias(n) for k, n in enumerate(reach)]))
