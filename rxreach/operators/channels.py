"""L1 channel rollups: one table per promotion channel and for prescriptions.

Each function takes the channel's input DataFrame and returns the rollup with
every level the reference emits, as one grouping-sets aggregate (see
``rollup.py``).  Quirks kept on purpose:

* email, congress and TRx "MONTHLY" periods are the month number without the
  year (same months of different years merge); calls use the month date;
* yearly / YTD levels group by year but do not output it, so several years
  give several rows with equal visible keys;
* a NULL dimension value is its own group, never merged with 'ALL';
* calls: the month level by (call type, duration) prints the duration as
  NULL, the year level by (call type, duration) keeps it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import (label_all, month_num, month_start, month_start_from_text,
                                 ratio_or_zero, year_num)
from .rollup import GID, grouping_sets, grouping_sets_with_reach, rolled


# --------------------------------------------------------------------------- calls
CALL_DIMS = ["month_dt", "yr", "tier", "call_type", "call_duration"]
CALL_SETS = [
    ["month_dt", "tier", "call_type", "call_duration"],   # monthly detail
    ["month_dt"],                                         # monthly, all
    ["month_dt", "call_type", "call_duration"],           # monthly by type (duration nulled)
    ["month_dt", "tier"],                                 # monthly by tier
    ["month_dt", "tier", "call_type"],                    # monthly by tier, type
    ["yr", "tier", "call_type", "call_duration"],         # yearly detail
    ["yr"],                                               # yearly, all
    ["yr", "call_type", "call_duration"],                 # yearly by type (duration kept)
    ["yr", "tier"],                                       # yearly by tier
    ["yr", "tier", "call_type"],                          # yearly by tier, type
]


def call_rollup(calls: DataFrame) -> DataFrame:
    base = calls.select(
        month_start("contact_date").alias("month_dt"),
        year_num("contact_date").alias("yr"),
        "tier", "call_type", "call_duration", "interaction_id", "customer_id")
    agg = grouping_sets_with_reach(
        base, CALL_DIMS, CALL_SETS, entity="customer_id",
        additive={"total_calls": F.count("interaction_id")},
        reach={"reached_customers": F.lit(True)})
    r = lambda d: rolled(CALL_DIMS, d)
    month_level = ~r("month_dt")
    return agg.select(
        F.when(month_level, F.lit("MONTH")).otherwise(F.lit("YEAR")).alias("time_granularity"),
        F.col("month_dt").alias("period"),
        label_all("tier", r("tier")).alias("tier"),
        label_all("call_type", r("call_type")).alias("call_type"),
        F.when(r("call_duration") | (month_level & r("tier")), F.lit(None).cast("int"))
         .otherwise(F.col("call_duration")).alias("call_duration"),
        F.col("total_calls").cast("bigint").alias("total_calls"),
        F.col("reached_customers").alias("reached_customers"),
    )


# ------------------------------------------------------- period x one-dimension rollups
def _period_by_dimension(base: DataFrame, dims: list[str], additive, reach=None,
                         entity: str | None = None) -> DataFrame:
    """Levels {month number, year} x {ALL, each of ``dims``}.

    Output: granularity, period, sub_granularity, sub_granularity_value, measures.
    With only sums (no distinct counts), every level rolls up from the finest
    one: the raw rows are summed once per (month, year, dims) — partial
    aggregation, one shuffle — and the levels expand over that small table.
    """
    all_dims = ["month_num", "year_num"] + dims
    sets = [[p] + extra for p in ("month_num", "year_num") for extra in [[]] + [[d] for d in dims]]
    if reach:
        agg = grouping_sets_with_reach(base, all_dims, sets, entity, additive, reach)
    else:
        finest = base.groupBy(*all_dims).agg(*[a.alias(n) for n, a in additive.items()])
        agg = grouping_sets(finest, all_dims, sets, [F.sum(n).alias(n) for n in additive])
    r = lambda d: rolled(all_dims, d)
    sub_name = F.lit("ALL")
    sub_value = F.lit("ALL")
    for d in reversed(dims):
        sub_name = F.when(~r(d), F.lit(d.upper())).otherwise(sub_name)
        sub_value = F.when(~r(d), F.col(d).cast("string")).otherwise(sub_value)
    monthly = ~r("month_num")
    measures = list(additive) + list(reach or {})
    return agg.select(
        F.when(monthly, F.lit("MONTHLY")).otherwise(F.lit("YEARLY")).alias("granularity"),
        F.when(monthly, F.col("month_num")).otherwise(F.col("year_num")).alias("period"),
        sub_name.alias("sub_granularity"),
        sub_value.alias("sub_granularity_value"),
        *[F.col(m).cast("bigint").alias(m) for m in measures],
    )


def email_rollup(emails: DataFrame) -> DataFrame:
    base = emails.select(
        "customer_id", "tier", "email_type", "subject_category",
        month_num("email_date").alias("month_num"), year_num("email_date").alias("year_num"),
        "delivery_status", "opened_flag", "clicked_flag", "reach_back")
    delivered = F.col("delivery_status") == "Delivered"
    return _period_by_dimension(
        base, ["tier", "email_type", "subject_category"],
        additive={
            "sent_count": F.count_if(delivered),
            "bounce_count": F.count_if(F.col("delivery_status") == "Bounced"),
            "open_count": F.count_if(F.col("opened_flag")),
            "click_count": F.count_if(F.col("clicked_flag")),
            "reach_back_count": F.count_if(F.col("reach_back")),
        },
        reach={
            "hcp_reached": delivered,
            "hcp_opened": F.col("opened_flag"),
            "hcp_clicked": F.col("clicked_flag"),
        },
        entity="customer_id")


def congress_rollup(congress: DataFrame) -> DataFrame:
    base = congress.select(
        "customer_id", "tier", "congress_name", "mode",
        month_num("start_time").alias("month_num"), year_num("start_time").alias("year_num"),
        "registered", "attended", "booth_visit", "post_congress_followup")
    flags = ["registered", "attended", "booth_visit", "post_congress_followup"]
    return _period_by_dimension(
        base, ["tier", "congress_name", "mode"],
        additive={f"total_{f}" if f != "registered" else "total_registrations":
                  F.count_if(F.col(f)) for f in flags},
        reach={f"hcp_{f}": F.col(f) for f in flags},
        entity="customer_id")


def trx_rollup(prescriptions: DataFrame) -> DataFrame:
    base = prescriptions.select(
        month_num("week").alias("month_num"), year_num("week").alias("year_num"),
        "drug_class", "trx_cnt", "trx_qty")
    return _period_by_dimension(
        base, ["drug_class"],
        additive={"total_trx_cnt": F.sum("trx_cnt"), "total_trx_qty": F.sum("trx_qty")})


# ------------------------------------------------------------ month + YTD rollups
def _month_and_ytd(df: DataFrame, dims: list[str], sums: list[str],
                   derived: dict) -> DataFrame:
    """Levels (month, dims) and (year, dims).

    As in the reference, the raw rows are summed per month first (partial
    aggregation, one shuffle) and the year level rolls up from those monthly
    sums.  Both levels hang on the one monthly exchange, which adaptive
    execution reuses, so no row is expanded.  Money columns (DECIMAL) are
    summed exactly and turned into DOUBLE last.
    """
    base = df.select(month_start_from_text("month").alias("month_dt"), *dims, *sums) \
             .withColumn("yr", F.year("month_dt").cast("int"))
    keys = ["month_dt", "yr"] + dims
    monthly = base.groupBy(*keys).agg(*[F.sum(s).alias(s) for s in sums])
    yearly = monthly.groupBy("yr", *dims).agg(*[F.sum(s).alias(s) for s in sums])
    def level(df: DataFrame, label: str, period) -> DataFrame:
        return df.select(F.lit(label).alias("time_granularity"), period.alias("period"), *dims,
                         *[expr.alias(name) for name, expr in derived.items()])
    return level(monthly, "MONTH", F.col("month_dt")).unionByName(
        level(yearly, "YTD", F.lit(None).cast("date")))


def _money(c: str):
    return F.col(c).cast("double")


def paid_search_rollup(paid: DataFrame) -> DataFrame:
    return _month_and_ytd(
        paid, ["search_engine", "campaign_id", "campaign_name"],
        ["impressions", "clicks", "cost"],
        {
            "impressions": F.col("impressions"),
            "clicks": F.col("clicks"),
            "cost": _money("cost"),
            "ctr": ratio_or_zero("clicks", "impressions"),
            "avg_cpc": ratio_or_zero(_money("cost"), "clicks"),
        })


def display_rollup(display: DataFrame) -> DataFrame:
    return _month_and_ytd(
        display, ["package"],
        ["impressions", "reach", "viewable_impressions", "clicks", "cost",
         "post_view_sessions", "post_click_sessions"],
        {
            "impressions": F.col("impressions"),
            "reach": F.col("reach"),
            "frequency": ratio_or_zero("impressions", "reach"),
            "viewable_impressions": F.col("viewable_impressions"),
            "viewability_rate": ratio_or_zero("viewable_impressions", "impressions"),
            "clicks": F.col("clicks"),
            "cost": _money("cost"),
            "ctr": ratio_or_zero("clicks", "impressions"),
            "avg_cpc": ratio_or_zero(_money("cost"), "clicks"),
            "cpm": ratio_or_zero(_money("cost"), "impressions") * F.lit(1000.0),
            "post_view_sessions": F.col("post_view_sessions"),
            "post_click_sessions": F.col("post_click_sessions"),
        })


WEBSITE_MEASURES = ["sessions", "engaged_sessions", "pageviews", "event_clicks",
                    "event_form_submit", "event_downloads", "event_registrations",
                    "scroll_25", "scroll_50", "scroll_75", "scroll_100"]


def website_rollup(website: DataFrame) -> DataFrame:
    return _month_and_ytd(website, ["source"], WEBSITE_MEASURES,
                          {m: F.col(m) for m in WEBSITE_MEASURES})


__all__ = ["call_rollup", "email_rollup", "congress_rollup", "trx_rollup",
           "paid_search_rollup", "display_rollup", "website_rollup", "GID"]
