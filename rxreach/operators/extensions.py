"""Analytics the reference's README announces but ships no SQL for.

DataFrame job over the same inputs and intermediate tables, with its own
oracle SQL.  Tunables live in ``ExtensionConfig``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.once import once
from ..functions.ordinal import _W, BEFORE, before_col, histogram, percentile_cont, rows_before
from ..functions.scalars import month_start, ratio_or_zero
from .omni import CHANNELS


@dataclass(frozen=True)
class ExtensionConfig:
    churn_weeks: int = 12          # weeks without TRx before the data end
    growth_window_days: int = 91   # 13 weeks
    growth_band_pct: int = 10      # +-10 % counts as stable
    contact_bands: tuple[int, ...] = (1, 2, 4)     # least contacts a month of each band after '0'


EXT = ExtensionConfig()


def _data_end(prescriptions: DataFrame):
    """The last prescription week, as a scalar subquery (computed once, inlined)."""
    return prescriptions.agg(F.max("week")).scalar()


def hcp_retention_rate(prescriptions: DataFrame) -> DataFrame:
    """Per month: active prescribers, those also active the next month, rate.

    Each (prescriber, month) row is emitted once as 'active in m' and once as
    'active in m+1' shifted back to m; one aggregate per (prescriber, month)
    pairs them up without a self-join.
    """
    active = (prescriptions.where(F.col("hcp_id").isNotNull() & F.col("week").isNotNull())
              .select("hcp_id", month_start("week").alias("month_date")).distinct())
    marks = active.select("hcp_id", "month_date", F.lit(1).alias("is_active"),
                          F.lit(0).alias("next_active")).unionByName(
        active.select("hcp_id", F.add_months("month_date", -1).alias("month_date"),
                      F.lit(0).alias("is_active"), F.lit(1).alias("next_active")))
    per_hcp = (marks.groupBy("hcp_id", "month_date")
               .agg(F.max("is_active").alias("a"), F.max("next_active").alias("n"))
               .where(F.col("a") == 1))
    return (per_hcp.groupBy("month_date")
            .agg(F.count(F.lit(1)).alias("active_hcps"), F.sum("n").cast("bigint").alias("retained_hcps"))
            .select("month_date", "active_hcps", "retained_hcps",
                    ratio_or_zero("retained_hcps", "active_hcps").alias("retention_rate")))


def churn_indicators(prescriptions: DataFrame, cfg: ExtensionConfig = EXT) -> DataFrame:
    """Per prescriber: last week, weeks since it at the data end, churn-risk flag."""
    per_hcp = once(prescriptions.groupBy("hcp_id").agg(F.max("week").alias("last_week")))
    last = per_hcp.where(F.col("hcp_id").isNotNull())
    weeks = F.floor(F.datediff(F.col("data_end"), F.col("last_week")) / 7).cast("int")
    # the data end is the latest of the per-prescriber weeks, those without an id included
    return (last.select("hcp_id", "last_week", _data_end(per_hcp.select(F.col("last_week").alias("week")))
                        .alias("data_end"))
            .select("hcp_id", "last_week", "data_end", weeks.alias("weeks_since_last"))
            .withColumn("churn_risk", F.when(F.col("weeks_since_last") >= cfg.churn_weeks, 1)
                        .otherwise(0)))


def hco_adoption(affiliated: DataFrame) -> DataFrame:
    """Per HCO and month: prescribers whose first TRx there falls in that month,
    and the running total.  The window is per HCO over its months only."""
    first = affiliated.groupBy("hco_id", "hcp_id").agg(F.min("week").alias("first_week"))
    per_month = (first.groupBy("hco_id", month_start("first_week").alias("adoption_month"))
                 .agg(F.count(F.lit(1)).alias("new_hcps")))
    w = (Window.partitionBy("hco_id").orderBy(F.col("adoption_month").asc_nulls_last())
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return per_month.select("hco_id", "adoption_month", "new_hcps",
                            F.sum("new_hcps").over(w).cast("bigint").alias("cumulative_hcps"))


def hco_growth_segment(affiliated: DataFrame, prescriptions: DataFrame,
                       cfg: ExtensionConfig = EXT) -> DataFrame:
    """HCO TRx of the last 13 weeks vs the 13 before, and GROWTH/DECLINE/STABLE.

    ``prescriptions`` only supplies the data end (its last week); any frame
    with all prescription weeks serves, e.g. the weekly pre-aggregate.
    """
    d = cfg.growth_window_days
    end = F.col("data_end")
    recent = F.col("week") > F.date_sub(end, d)
    prior = (F.col("week") > F.date_sub(end, 2 * d)) & (F.col("week") <= F.date_sub(end, d))
    per_hco = (affiliated.select("hco_id", "week", "trx", _data_end(prescriptions).alias("data_end"))
               .groupBy("hco_id")
               .agg(F.sum(F.when(recent, F.col("trx")).otherwise(0)).cast("bigint").alias("recent_trx"),
                    F.sum(F.when(prior, F.col("trx")).otherwise(0)).cast("bigint").alias("prior_trx")))
    r, p, b = F.col("recent_trx"), F.col("prior_trx"), cfg.growth_band_pct
    return per_hco.withColumn(
        "growth_segment",
        F.when(r * 100 > p * (100 + b), F.lit("GROWTH"))
         .when(r * 100 < p * (100 - b), F.lit("DECLINE"))
         .otherwise(F.lit("STABLE")))


def territory_promo_vs_trx(exposure: DataFrame) -> DataFrame:
    """Per territory and month: promotion volumes next to TRx."""
    return (exposure.groupBy("territory_id", "month", "year")
            .agg(F.count(F.lit(1)).alias("hcps"),
                 *[F.sum(c).cast("bigint").alias(c) for c in
                   ("total_calls", "total_emails_sent", "total_congress_invites", "total_trx")]))


def _per_channel(exposure: DataFrame, dims: tuple[str, ...], measures: dict) -> DataFrame:
    """Aggregates per channel (and ``dims``): channels travel as columns through
    the aggregate and are unpivoted on its few rows.  ``measures``: name ->
    aggregate of (reach flag, volume)."""
    volume = {prefix: F.col(vol).cast("bigint") for _, prefix, vol in CHANNELS}
    volume["overall"] = sum(volume.values(), F.lit(0))
    labels = [(label, prefix) for label, prefix, _ in CHANNELS] + [("OVERALL", "overall")]
    wide = exposure.groupBy(*dims).agg(F.count(F.lit(1)).alias("hcp_months"), *[
        agg(F.col(f"{prefix}_reach_flag"), volume[prefix]).alias(f"{prefix}__{name}")
        for _, prefix in labels for name, agg in measures.items()])
    rows = F.inline(F.array(*[F.struct(F.lit(label).alias("channel"),
                                       *[F.col(f"{prefix}__{name}").alias(name) for name in measures])
                              for label, prefix in labels]))
    return wide.where("hcp_months > 0").select(*dims, "hcp_months", rows)


def channel_effectiveness(exposure: DataFrame, dims: tuple[str, ...] = ()) -> DataFrame:
    """Per channel over all HCP-months: TRx per reached HCP-month, writer rate
    reached vs not reached, and a rank.  The rank's window runs over the four
    aggregated channel rows only.  ``dims`` (e.g. the tier) splits all of it,
    the rank included."""
    writer = F.col("total_trx") > 0
    per = _per_channel(exposure, dims, {
        "reached": lambda r, _: F.count_if(r == 1),
        "trx_reached": lambda r, _: F.sum(F.when(r == 1, F.col("total_trx")).otherwise(0)).cast("bigint"),
        "writers_reached": lambda r, _: F.count_if((r == 1) & writer),
        "writers_not_reached": lambda r, _: F.count_if((r != 1) & writer)})
    per = per.select(
        *dims, "channel", "hcp_months", "reached", "trx_reached",
        ratio_or_zero("trx_reached", "reached").alias("trx_per_reached"),
        ratio_or_zero("writers_reached", "reached").alias("writer_rate_reached"),
        ratio_or_zero("writers_not_reached", F.col("hcp_months") - F.col("reached"))
        .alias("writer_rate_not_reached"))
    return per.select(
        "*", (F.col("writer_rate_reached") - F.col("writer_rate_not_reached")).alias("writer_rate_lift"),
        F.rank().over(Window.partitionBy(*dims).orderBy(F.col("trx_per_reached").desc_nulls_first()))
         .cast("int").alias("effectiveness_rank"))


def channel_effectiveness_by_tier(exposure: DataFrame) -> DataFrame:
    return channel_effectiveness(exposure.withColumnRenamed("tier", "target_type"), ("target_type",))


def channel_mix(exposure: DataFrame) -> DataFrame:
    """Per combination of channels that ever reached a prescriber: prescribers,
    writers and TRx.  One aggregate per prescriber, then at most eight rows."""
    reach = [F.max(f"{prefix}_reach_flag").alias(prefix) for _, prefix, _ in CHANNELS]
    per_hcp = exposure.groupBy("hcp_id").agg(*reach, F.sum("total_trx").alias("trx"))
    mix = F.concat_ws("+", *[F.when(F.col(prefix) == 1, label) for label, prefix, _ in CHANNELS])
    return (per_hcp.groupBy(F.when(mix == "", "None").otherwise(mix).alias("channel_mix"))
            .agg(F.count(F.lit(1)).alias("hcps"),
                 F.count(F.when(F.col("trx") > 0, 1)).alias("writers"),
                 F.sum("trx").cast("bigint").alias("total_trx"))
            .select("*", ratio_or_zero("writers", "hcps").alias("writer_rate"),
                    ratio_or_zero("total_trx", "hcps").alias("trx_per_hcp")))


def contact_frequency(exposure: DataFrame, cfg: ExtensionConfig = EXT) -> DataFrame:
    """Per band of contacts (calls, emails sent, congress invites) of an HCP in
    a month: HCP-months, engagement rates and TRx."""
    contacts = F.col("total_calls") + F.col("total_emails_sent") + F.col("total_congress_invites")
    band = F.lit("0")
    for low, after in zip(cfg.contact_bands, (*cfg.contact_bands[1:], None)):
        label = f"{low}+" if after is None else str(low) if after == low + 1 else f"{low}-{after - 1}"
        band = F.when(contacts >= low, label).otherwise(band)
    return (exposure.groupBy(band.alias("contact_band"))
            .agg(F.count(F.lit(1)).alias("hcp_months"),
                 F.count(F.when(F.col("overall_engagement_flag") == 1, 1)).alias("engaged"),
                 F.count(F.when(F.col("overall_deep_engagement_flag") == 1, 1)).alias("deep_engaged"),
                 F.sum("total_trx").cast("bigint").alias("total_trx"))
            .select("*", ratio_or_zero("engaged", "hcp_months").alias("engagement_rate"),
                    ratio_or_zero("deep_engaged", "hcp_months").alias("deep_engagement_rate"),
                    ratio_or_zero("total_trx", "hcp_months").alias("trx_per_hcp_month")))


def opportunity_territories(exposure: DataFrame) -> DataFrame:
    """Territories with above-median reach rate but below-median TRx per HCP."""
    hcp = (exposure.where(F.col("territory_id").isNotNull())
           .groupBy("territory_id", "hcp_id")
           .agg(F.max("overall_reach_flag").alias("reached"), F.sum("total_trx").alias("trx")))
    # one row a territory, written once for the rows and both medians
    per = once(hcp.groupBy("territory_id")
               .agg(F.count("hcp_id").alias("hcps"),
                    F.count(F.when(F.col("reached") == 1, F.col("hcp_id"))).alias("reached_hcps"),
                    F.sum("trx").cast("bigint").alias("total_trx"))
               .select("territory_id", "hcps", "reached_hcps", "total_trx",
                       ratio_or_zero("reached_hcps", "hcps").alias("reach_rate"),
                       ratio_or_zero("total_trx", "hcps").alias("trx_per_hcp")))
    # the two medians are scalar subqueries (computed once, inlined)
    median_reach = percentile_cont(per, "reach_rate", 0.5).scalar()
    median_trx = percentile_cont(per, "trx_per_hcp", 0.5).scalar()
    flag = (F.col("reach_rate") > median_reach) & (F.col("trx_per_hcp") < median_trx)
    return per.select(*per.columns, F.when(flag, 1).otherwise(0).alias("opportunity"))


def hcp_concentration(summary: DataFrame) -> DataFrame:
    """Per prescriber: TRx rank, cumulative TRx of all prescribers ranked at or
    above (ties included) and its share of all TRx.

    Built on the distributed prefix sums of ``ordinal``: a histogram of the
    totals carries both the count and the TRx of each value, so no window
    ever spans all prescribers.  ``summary`` is read for the histogram and for
    the rows, so give a written table.
    """
    rows = (summary.where(F.col("total_trx").isNotNull())
            .select("hcp_id", "total_trx", F.col("total_trx").alias("_t")))
    hist = histogram(rows, "total_trx", sums=("_t",))
    pre = rows_before(hist, "total_trx", (_W, "_t"), ascending=False)
    grand = hist.agg(F.sum("_t")).scalar()
    cum = F.col(before_col("_t")) + F.col("_t")
    per_value = pre.select(F.col("total_trx").alias("_v"),
                           (F.col(BEFORE) + 1).cast("int").alias("trx_rank"),
                           cum.cast("bigint").alias("cumulative_trx"),
                           (cum.cast("double") / grand.cast("double")).alias("cumulative_share"))
    return (rows.join(per_value, rows["total_trx"] == per_value["_v"])
            .select("hcp_id", "total_trx", "trx_rank", "cumulative_trx", "cumulative_share"))


def engagement_trx_correlation(exposure: DataFrame) -> DataFrame:
    """Per channel: Pearson correlation of channel volume and TRx over HCP-months
    (rounded to 9 decimals, so engines agree despite summation order)."""
    trx = F.col("total_trx").cast("double")
    return _per_channel(exposure, (), {
        "volume_trx_corr": lambda _, volume: F.round(F.corr(volume.cast("double"), trx), 9),
    }).select("channel", "hcp_months", "volume_trx_corr")


def from_tables(prescriptions: DataFrame, exposure: DataFrame, summary: DataFrame, affiliated: DataFrame):
    """Builders for the refresh job, reusing its already written tables
    (``prescriptions``: rows or the weekly pre-aggregate)."""
    return {
        "hcp_retention_rate": lambda: hcp_retention_rate(prescriptions),
        "churn_indicators": lambda: churn_indicators(prescriptions),
        "hco_adoption": lambda: hco_adoption(affiliated),
        "hco_growth_segment": lambda: hco_growth_segment(affiliated, prescriptions),
        "territory_promo_vs_trx": lambda: territory_promo_vs_trx(exposure),
        "channel_effectiveness": lambda: channel_effectiveness(exposure),
        "channel_effectiveness_by_tier": lambda: channel_effectiveness_by_tier(exposure),
        "channel_mix": lambda: channel_mix(exposure),
        "contact_frequency": lambda: contact_frequency(exposure),
        "opportunity_territories": lambda: opportunity_territories(exposure),
        "hcp_concentration": lambda: hcp_concentration(summary),
        "engagement_trx_correlation": lambda: engagement_trx_correlation(exposure),
    }


__all__ = ["ExtensionConfig", "EXT", "hcp_retention_rate", "churn_indicators", "hco_adoption",
           "hco_growth_segment", "territory_promo_vs_trx", "channel_effectiveness", "channel_effectiveness_by_tier",
           "channel_mix", "contact_frequency", "opportunity_territories", "hcp_concentration", "engagement_trx_correlation"]
