"""Prescriber (HCP) behaviour and territory tables.

Joining every prescription row to the HCP master and then aggregating (the
reference's order) shuffles the largest table by prescriber, and a prescriber
holding a large share of the rows becomes one huge join partition.  Here the
prescriptions are aggregated first and the much smaller result is joined:

* ``multiplicity``: master rows per text id.  The reference's left join
  repeats each prescription once per matching master row (at least once), so
  sums are multiplied by it while MIN / MAX / COUNT DISTINCT / AVG are not
  changed by it.  With a clean master it is 1 everywhere.
* tiers come straight from the master: the distinct (prescriber, tier) pairs
  of the joined base are exactly the master's pairs for the prescribers that
  have prescriptions (NULL for unmapped ones).

Only ``trx_base`` itself, a row-level output, performs the row-level join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT, Thresholds
from ..functions.once import once
from ..functions.ordinal import with_rank
from ..functions.scalars import month_start
from ..functions.spread import spread_join


def multiplicity(master: DataFrame) -> DataFrame:
    """(hcp_id, mult): number of master rows per prescriber text id."""
    return master.groupBy("hcp_id").agg(F.count(F.lit(1)).alias("mult"))


def given_or(mult: DataFrame | None, master: DataFrame) -> DataFrame:
    """The written table of multiplicities where there is one."""
    return multiplicity(master) if mult is None else mult


def _times_mult(c: str) -> Column:
    return (F.col(c) * F.coalesce(F.col("mult"), F.lit(1))).cast("bigint")


def trx_base(prescriptions: DataFrame, master: DataFrame, counts: DataFrame | None = None) -> DataFrame:
    """Prescriptions + master tier + month and year (unmapped keep NULL tier).
    ``counts``: rows per prescriber, where known."""
    m = master.select("hcp_id", F.col("target_type").alias("tier"))
    rows = prescriptions.select("hcp_id", "territory_id", "week", "trx_cnt")
    return (spread_join(rows, m, "hcp_id", "left", counts)
            .select("hcp_id", "territory_id", "tier", "week",
                    month_start("week").alias("month_date"),
                    F.year("week").cast("int").alias("year_num"), "trx_cnt"))


def trx_week_bounds(prescriptions: DataFrame) -> DataFrame:
    """First and last prescription week overall (a dead CTE in the reference)."""
    return prescriptions.agg(F.min("week").alias("year_start"), F.max("week").alias("year_end"))


def _per_prescriber(prescriptions: DataFrame) -> DataFrame:
    """``prescriptions``: rows, or the weekly pre-aggregate (`_n` values a row)."""
    n = F.sum("_n") if "_n" in prescriptions.columns else F.count("trx_cnt")
    return (prescriptions.groupBy("hcp_id")
            .agg(F.min("week").alias("first_week"), F.max("week").alias("last_week"),
                 F.countDistinct("week").alias("weeks_active"),
                 F.sum("trx_cnt").alias("_sum"), n.alias("_n")))


def _avg(sum_col: str, n_col: str) -> Column:
    return F.when(F.col(n_col) > 0, F.col(sum_col).cast("double") / F.col(n_col).cast("double"))


def hcp_summary(prescriptions: DataFrame, master: DataFrame, mult: DataFrame | None = None) -> DataFrame:
    """Per prescriber: first/last week, weeks active, total and average TRx."""
    return (_per_prescriber(prescriptions).join(given_or(mult, master), "hcp_id", "left")
            .select("hcp_id", "first_week", "last_week", "weeks_active",
                    _times_mult("_sum").alias("total_trx"),
                    _avg("_sum", "_n").alias("avg_trx")))


def _segment(total: Column, t: Thresholds) -> Column:
    return (F.when(total >= t.volume_high, F.lit("HIGH"))
             .when(total >= t.volume_medium, F.lit("MEDIUM"))
             .otherwise(F.lit("LOW")))


def hcp_writing_analysis(prescriptions: DataFrame, master: DataFrame,
                         t: Thresholds = DEFAULT) -> DataFrame:
    """Per (text id, master id): activity window, totals and two segments."""
    pairs = master.groupBy("hcp_id", "id").agg(F.count(F.lit(1)).alias("mult"))
    h = _per_prescriber(prescriptions).join(pairs, "hcp_id", "left")
    first, last, weeks = F.col("first_week"), F.col("last_week"), F.col("total_weeks_active")
    pattern = (F.when((first <= F.lit(t.consistent_first_by)) & (last >= F.lit(t.consistent_last_from))
                      & (weeks > t.consistent_min_weeks), F.lit("CONSISTENT"))
                .when((first <= F.lit(t.dropoff_first_by)) & (last < F.lit(t.dropoff_last_before)),
                      F.lit("DROP_OFF"))
                .when(first > F.lit(t.late_first_after), F.lit("LATE_ADOPTER"))
                .otherwise(F.lit("INTERMITTENT")))
    h = h.select("id", "hcp_id", "first_week", "last_week",
                 F.col("weeks_active").alias("total_weeks_active"),
                 _times_mult("_sum").alias("total_trx"),
                 F.round(_avg("_sum", "_n"), 2).alias("avg_weekly_trx"))
    return h.select("*", pattern.alias("writing_pattern"),
                    _segment(F.col("total_trx"), t).alias("volume_segment"))


def monthly_active_hcps(prescriptions: DataFrame) -> DataFrame:
    """Distinct prescribers per month (the reference calls it 'retention')."""
    return (prescriptions.groupBy(month_start("week").alias("month_date"))
            .agg(F.countDistinct("hcp_id").alias("active_hcps"))
            .orderBy(F.col("month_date").asc_nulls_last()))


def cohort_analysis(summary: DataFrame) -> DataFrame:
    """Prescribers and their TRx by the month of their first prescription."""
    return (summary.groupBy(month_start("first_week").alias("cohort_month"))
            .agg(F.count(F.lit(1)).alias("hcp_count"),
                 F.sum("total_trx").cast("bigint").alias("cohort_total_trx"))
            .orderBy(F.col("cohort_month").asc_nulls_last()))


def hcp_behavior(summary: DataFrame, master: DataFrame, t: Thresholds = DEFAULT) -> DataFrame:
    """Summary + tier (one row per distinct tier) + 3-way pattern + value segment."""
    tiers = master.select("hcp_id", F.col("target_type").alias("tier")).distinct()
    weeks = F.col("weeks_active")
    pattern = (F.when(weeks >= t.behaviour_consistent, F.lit("CONSISTENT"))
                .when(weeks.between(t.behaviour_moderate_low, t.behaviour_moderate_high),
                      F.lit("MODERATE"))
                .otherwise(F.lit("LOW_ACTIVITY")))
    return (summary.join(tiers, "hcp_id", "left")
            .select("hcp_id", "first_week", "last_week", "weeks_active", "total_trx", "avg_trx",
                    "tier", pattern.alias("writing_pattern"),
                    _segment(F.col("total_trx"), t).alias("value_segment")))


def tier_behavior_matrix(behavior: DataFrame) -> DataFrame:
    return (behavior.groupBy("tier", "writing_pattern")
            .agg(F.count(F.lit(1)).alias("hcp_count"),
                 F.sum("total_trx").cast("bigint").alias("total_trx"))
            .orderBy(F.col("tier").asc_nulls_last(), F.col("writing_pattern").asc_nulls_last()))


def territory_prescriber_trx(prescriptions: DataFrame, master: DataFrame,
                             mult: DataFrame | None = None) -> DataFrame:
    """(territory_id, hcp_id, trx): TRx per territory and prescriber, fan-out applied."""
    return (prescriptions.groupBy("territory_id", "hcp_id").agg(F.sum("trx_cnt").alias("_sum"))
            .join(given_or(mult, master), "hcp_id", "left")
            .select("territory_id", "hcp_id", _times_mult("_sum").alias("trx")))


def territory_ranking(prescriptions: DataFrame, master: DataFrame, mult: DataFrame | None = None) -> DataFrame:
    """Writers and TRx per territory (NULL territory is a group), ranked by TRx."""
    per_territory = once(territory_prescriber_trx(prescriptions, master, mult)
                         .groupBy("territory_id")
                         .agg(F.count("hcp_id").alias("writing_hcps"),
                              F.sum("trx").cast("bigint").alias("total_trx")))
    return with_rank(per_territory, "total_trx", out="territory_rank",
                     ascending=False, nulls_first=True)


def growth_funnel(summary: DataFrame, t: Thresholds = DEFAULT) -> DataFrame:
    """Writers, active writers and high-value writers (one row).

    ``summary`` holds one row per prescriber, so counting ids per condition
    equals the reference's COUNT(DISTINCT ...), without a distinct step.
    """
    hcp = F.col("hcp_id")
    return summary.agg(
        F.count(hcp).alias("total_writers"),
        F.count(F.when(F.col("weeks_active") >= t.funnel_active_weeks, hcp)).alias("active_hcps"),
        F.count(F.when(F.col("total_trx") >= t.funnel_high_trx, hcp)).alias("high_value_hcps"))
