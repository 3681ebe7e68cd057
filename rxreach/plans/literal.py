"""The headline tables in their plainest form, as a baseline to time against.

Every prescription row meets the master before anything is summed, every level
is an aggregate of its own, ranks and percentiles are Spark's one-task forms,
and the exposure is a spine joined to each channel.  Results equal those of
``catalog``; only the bench and its test use these.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import DEFAULT as T
from ..operators import omni as O
from ..sources import Inputs


def _base(i: Inputs) -> DataFrame:
    tiers = i.hcp_master.select("hcp_id", F.col("target_type").alias("tier"))
    return i.prescriptions.join(tiers, "hcp_id", "left")


def hcp_summary(i: Inputs) -> DataFrame:
    return _base(i).groupBy("hcp_id").agg(
        F.min("week").alias("first_week"), F.max("week").alias("last_week"),
        F.countDistinct("week").alias("weeks_active"), F.sum("trx_cnt").alias("total_trx"),
        F.avg("trx_cnt").alias("avg_trx"))


def territory_ranking(i: Inputs) -> DataFrame:
    per = _base(i).groupBy("territory_id").agg(
        F.countDistinct("hcp_id").alias("writing_hcps"), F.sum("trx_cnt").alias("total_trx"))
    return per.withColumn("territory_rank", F.rank().over(Window.orderBy(F.col("total_trx").desc_nulls_first())))


def _hco_base(i: Inputs) -> DataFrame:
    hcos = i.hcp_master.where("hco_id is not null").select("hcp_id", "hco_id")
    return _base(i).join(hcos, "hcp_id")


def high_value_hco(i: Inputs) -> DataFrame:
    per = _hco_base(i).groupBy("hco_id").agg(
        F.countDistinct("hcp_id").alias("linked_hcps"), F.countDistinct("territory_id").alias("territory_spread"),
        F.sum("trx_cnt").alias("total_trx"), F.avg("trx_cnt").alias("avg_weekly_trx"),
        F.countDistinct("week").alias("active_weeks"))
    cut = per.agg(F.percentile("total_trx", T.hco_percentile)).scalar()
    return per.withColumn("hco_segment", F.when(F.col("total_trx") >= cut, "HIGH_VALUE").otherwise("NORMAL"))


def dependency_risk(i: Inputs) -> DataFrame:
    high = high_value_hco(i).where("hco_segment = 'HIGH_VALUE'").select("hco_id")
    own = _hco_base(i).join(high, "hco_id", "left_semi").groupBy("territory_id").agg(F.sum("trx_cnt").alias("hco_trx"))
    every = _base(i).groupBy("territory_id").agg(F.sum("trx_cnt").alias("total_trx"))
    share = F.col("hco_trx").cast("double") / F.col("total_trx").cast("double")
    return own.join(every, "territory_id").withColumn("dependency_ratio", share).withColumn(
        "risk_flag", F.when(share > T.dependency_high, "HIGH_DEPENDENCY").when(share > T.dependency_medium, "MEDIUM_DEPENDENCY")
        .otherwise("LOW_DEPENDENCY"))


def omni_exposure(i: Inputs) -> DataFrame:
    out = O.hcp_month_spine(i.calls, i.emails, i.congress, i.prescriptions, i.hcp_master)
    for part in (O.hcp_month_calls(i.calls), O.hcp_month_emails(i.emails), O.hcp_month_congress(i.congress),
                 O.hcp_month_trx(i.prescriptions, i.hcp_master)):
        out = out.join(part, O.KEYS, "left")
    out = out.fillna(0, O.VOLUMES).where(
        "total_calls + total_emails_sent + total_congress_invites > 0 or total_trx > 0").where("hcp_id is not null")
    master = i.hcp_master.select(F.col("id").alias("hcp_id"), "hco_id", "territory_id", F.col("target_type").alias("tier"))
    out = out.join(master, "hcp_id", "left")
    steps = {"reach": ("total_calls", "total_emails_sent", "total_congress_invites"),
             "engagement": ("total_calls", "total_emails_opened", "total_congress_reg"),
             "deep_engagement": ("total_calls", "total_emails_clicked", "total_congress_attend")}
    flags = {f"{channel}_{step}_flag": (F.col(c) > 0).cast("int")
             for step, columns in steps.items() for channel, c in zip(("calls", "email", "congress"), columns)}
    flags |= {f"overall_{step}_flag": (F.greatest(*columns) > 0).cast("int") for step, columns in steps.items()}
    return out.withColumns(flags)


def omni_performance(i: Inputs) -> DataFrame:
    long = O.channel_long(omni_exposure(i))
    def level(month: bool, target: bool) -> DataFrame:
        keys = ["month"] * month + ["year"] + ["target_type"] * target + ["channel"]
        writer = F.col("total_trx") > 0
        hcps = {"total_writers": writer}
        trx = {"total_trx": F.sum("total_trx")}
        for name, flag in (("reached", "reach_flag"), ("engaged", "engagement_flag"), ("deep_engaged", "deep_engagement_flag")):
            on = F.col(flag) == 1
            hcps |= {f"{name}_hcps": on, f"writers_{name}": on & writer}
            trx[f"trx_from_{name}"] = F.sum(F.when(on, F.col("total_trx")).otherwise(0))
        per = long.groupBy(*keys).agg(*[F.countDistinct(F.when(on, F.col("hcp_id"))).alias(n) for n, on in hcps.items()],
                                      *[s.alias(n) for n, s in trx.items()], F.sum("channel_volume").alias("volume"))
        ratio = F.when(F.col("reached_hcps") > 0, F.col("volume").cast("double") / F.col("reached_hcps")).otherwise(0.0)
        return per.withColumns({
            "time_granularity": F.lit("MONTHLY" if month else "YEARLY"), "reach_frequency": ratio,
            "month": F.col("month") if month else F.lit(None).cast("int"),
            "target_type": F.col("target_type") if target else F.lit("ALL")}).drop("volume")
    parts = [level(m, t) for m in (True, False) for t in (True, False)]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


LITERAL: dict[str, Callable[[Inputs], DataFrame]] = {
    f.__name__: f for f in (hcp_summary, territory_ranking, high_value_hco, dependency_risk, omni_exposure, omni_performance)}
