"""Institution (HCO) value, concentration and territory dependency.

The reference's HCO base joins prescriptions to the master twice (once for
the tier, once for the HCO), so each prescription row is repeated
``mult(hcp) x (affiliations of hcp)`` times.  For the aggregates that base is
rebuilt from prescriptions pre-summed per (prescriber, territory, week) and
the master's affiliation pairs, with the repetition carried as a weight —
the same totals, but the large side is reduced before any join.
``hco_base`` itself is a row-level output: one join of the prescriptions with
the master's affiliation pairs, each repeated as often as the reference's
first join would repeat it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import DEFAULT, Thresholds
from ..functions.ordinal import percentile_cont
from ..functions.scalars import month_start, ratio
from ..functions.spread import spread_join
from .behavior import given_or

HIGH, NORMAL = "HIGH_VALUE", "NORMAL"


def hco_base(prescriptions: DataFrame, master: DataFrame, mult: DataFrame | None = None,
             counts: DataFrame | None = None) -> DataFrame:
    """Row level: base rows of prescribers with an affiliation (NULL HCO dropped).

    The reference joins prescriptions to the master twice (tier, then HCO).
    The same rows come from one join with a master-side table that holds
    each (prescriber, HCO) pair ``mult`` times, so the large side meets a
    single join, which deals a hot prescriber's rows over many tasks
    (``counts``: rows per prescriber, where known).
    """
    pairs = (master.where(F.col("hco_id").isNotNull()).select("hcp_id", "hco_id")
             .join(given_or(mult, master), "hcp_id", "inner")
             .select("hcp_id", "hco_id", F.explode(F.sequence(F.lit(1), F.col("mult"))).alias("_copy")))
    base = prescriptions.select("hcp_id", "territory_id", "week",
                                month_start("week").alias("month_date"), "trx_cnt")
    return (spread_join(base, pairs, "hcp_id", "inner", counts)
                .select("hcp_id", "hco_id", "territory_id", "week", "month_date", "trx_cnt"))


def weekly_trx(prescriptions: DataFrame) -> DataFrame:
    """(hcp_id, territory_id, week, _sum, _n): the HCO chain's one pre-aggregate.

    ``_sum`` = TRx, ``_n`` = number of non-NULL TRx values.  Every HCO and
    territory total below is derived from it; where a query needs it more than
    once it is written first, so the prescriptions are read once.
    """
    return (prescriptions.groupBy("hcp_id", "territory_id", "week")
            .agg(F.sum("trx_cnt").alias("_sum"), F.count("trx_cnt").alias("_n")))


def as_prescriptions(weekly: DataFrame) -> DataFrame:
    """The pre-aggregate in the place of prescription rows: every table that
    sums TRx, or looks at prescribers and weeks only, comes out the same."""
    return weekly.withColumnRenamed("_sum", "trx_cnt")


def affiliated_trx(weekly: DataFrame, master: DataFrame, mult: DataFrame | None = None) -> DataFrame:
    """Weighted HCO base: (hcp_id, hco_id, territory_id, week, trx, n).

    ``trx`` = TRx of that prescriber-territory-week times the base's
    repetition; ``n`` = number of non-NULL TRx values times the same.
    """
    aff = (master.where(F.col("hco_id").isNotNull()).select("hcp_id", "hco_id")
           .join(given_or(mult, master), "hcp_id", "inner"))
    return (weekly.join(aff, "hcp_id", "inner")
            .select("hcp_id", "hco_id", "territory_id", "week",
                    (F.col("_sum") * F.col("mult")).cast("bigint").alias("trx"),
                    (F.col("_n") * F.col("mult")).cast("bigint").alias("n")))


def hco_summary(affiliated: DataFrame) -> DataFrame:
    """Per HCO: linked prescribers, territory spread, TRx, average, active weeks."""
    return (affiliated.groupBy("hco_id")
            .agg(F.countDistinct("hcp_id").alias("linked_hcps"),
                 F.countDistinct("territory_id").alias("territory_spread"),
                 F.sum("trx").cast("bigint").alias("total_trx"),
                 F.sum("trx").alias("_sum"), F.sum("n").alias("_n"),
                 F.countDistinct("week").alias("active_weeks"))
            .select("hco_id", "linked_hcps", "territory_spread", "total_trx",
                    F.when(F.col("_n") > 0, F.col("_sum").cast("double") / F.col("_n").cast("double"))
                     .alias("avg_weekly_trx"),
                    "active_weeks"))


def hco_value_cutoff(summary: DataFrame, t: Thresholds = DEFAULT) -> DataFrame:
    """One row: the continuous percentile of HCO totals used as the cut-off."""
    return percentile_cont(summary, "total_trx", t.hco_percentile, out="trx_cutoff")


def high_value_hco(summary: DataFrame, t: Thresholds = DEFAULT) -> DataFrame:
    """Summary + HIGH_VALUE (total >= cut-off) or NORMAL.

    The summary is read for the cut-off and for the rows, so give a written table.
    """
    # the cut-off is one value: a scalar subquery, computed once and inlined
    cutoff = hco_value_cutoff(summary, t).scalar()
    return summary.select(*summary.columns,
                          F.when(F.col("total_trx") >= cutoff, F.lit(HIGH))
                           .otherwise(F.lit(NORMAL)).alias("hco_segment"))


def hco_concentration(high_value: DataFrame) -> DataFrame:
    """Per segment: HCOs, TRx and share of all HCO TRx.

    The share's window runs over the aggregated segments (at most two rows).
    """
    per_segment = (high_value.groupBy("hco_segment")
                   .agg(F.count(F.lit(1)).alias("hco_count"),
                        F.sum("total_trx").cast("bigint").alias("segment_trx")))
    return per_segment.select(
        "hco_segment", "hco_count", "segment_trx",
        ratio("segment_trx", F.sum("segment_trx").over(Window.partitionBy())).alias("trx_share"))


def _high_value_ids(high_value: DataFrame) -> DataFrame:
    return high_value.where(F.col("hco_segment") == HIGH).select("hco_id")


def _high_value_sums(affiliated: DataFrame, high_value: DataFrame) -> DataFrame:
    """(hco_id, territory_id, trx) of high-value HCOs: summed to that grain
    before the semi-join, so a hot institution is one row per territory."""
    sums = affiliated.groupBy("hco_id", "territory_id").agg(F.sum("trx").alias("trx"))
    return sums.join(_high_value_ids(high_value), "hco_id", "left_semi")


def high_value_hco_territory(affiliated: DataFrame, high_value: DataFrame) -> DataFrame:
    """Per territory: distinct high-value HCOs and their TRx."""
    return (_high_value_sums(affiliated, high_value).groupBy("territory_id")
            .agg(F.count("hco_id").alias("high_value_hco_count"),
                 F.sum("trx").cast("bigint").alias("total_trx"))
            .orderBy(F.col("total_trx").desc_nulls_first()))


def territory_totals(weekly: DataFrame, master: DataFrame, mult: DataFrame | None = None) -> DataFrame:
    """TRx per territory of the base (NULL territory is a group), fan-out
    applied to (prescriber, territory) sums."""
    sums = weekly.groupBy("hcp_id", "territory_id").agg(F.sum("_sum").alias("_sum"))
    return (sums.join(given_or(mult, master), "hcp_id", "left")
            .groupBy("territory_id")
            .agg(F.sum(F.col("_sum") * F.coalesce(F.col("mult"), F.lit(1))).cast("bigint")
                 .alias("total_trx")))


def territory_high_value_trx(affiliated: DataFrame, high_value: DataFrame) -> DataFrame:
    """TRx of high-value HCOs per territory."""
    return (_high_value_sums(affiliated, high_value)
            .groupBy("territory_id").agg(F.sum("trx").cast("bigint").alias("hco_trx")))


def dependency_risk(territory_hco: DataFrame, totals: DataFrame,
                    t: Thresholds = DEFAULT) -> DataFrame:
    """Share of a territory's TRx that comes from high-value HCOs, and its band.

    Inner join: territories without a high-value HCO, and the NULL territory,
    are absent.  The ratio is unguarded (a zero total raises under ANSI).
    """
    j = territory_hco.join(totals, "territory_id", "inner")
    r = ratio("hco_trx", "total_trx")
    return j.select(
        "territory_id", "hco_trx", "total_trx", r.alias("dependency_ratio"),
        F.when(r > t.dependency_high, F.lit("HIGH_DEPENDENCY"))
         .when(r > t.dependency_medium, F.lit("MEDIUM_DEPENDENCY"))
         .otherwise(F.lit("LOW_DEPENDENCY")).alias("risk_flag"))
