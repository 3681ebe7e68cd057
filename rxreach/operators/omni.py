"""Omni-channel integration: HCP x month exposure (L1) and channel performance (L2).

The reference builds L1 as a distinct key spine over four sources, four
per-channel aggregates and five left joins.  Here it is one tagged union of
the channel rows and one ``groupBy(hcp_id, month, year)``: every (HCP, month)
that appears in any source is exactly one group, so the spine and the joins
disappear (one shuffle instead of six).  Two guards keep the reference's
results: rows with a NULL key are dropped before grouping (in the reference
they never match a join and are removed by the final filter) and every
measure is coalesced to 0.

Prescriptions are summed per (prescriber text id, month, year) *before* the
join to the master, so the join sees at most one row per prescriber-month
whatever the skew of the raw rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import flag, month_num, ratio_or_zero, year_num
from .rollup import grouping_sets_with_reach, rolled

KEYS = ["hcp_id", "month", "year"]


def _keyed(df: DataFrame, hcp: str, date_col: str) -> list[Column]:
    return [F.col(hcp).alias("hcp_id"), month_num(date_col).alias("month"),
            year_num(date_col).alias("year")]


def _is_true(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit(False))


# ----------------------------------------------------------------- per-channel CTEs
def hcp_month_calls(calls: DataFrame) -> DataFrame:
    """Distinct interactions per HCP-month."""
    return (calls.select(*_keyed(calls, "customer_id", "contact_date"), "interaction_id")
                 .groupBy(*KEYS)
                 .agg(F.countDistinct("interaction_id").alias("total_calls")))


def _email_measures() -> list[Column]:
    return [F.sum(flag(F.col("delivery_status") == "Delivered")).cast("bigint").alias("total_emails_sent"),
            F.sum(flag(_is_true("opened_flag"))).cast("bigint").alias("total_emails_opened"),
            F.sum(flag(_is_true("clicked_flag"))).cast("bigint").alias("total_emails_clicked")]


def hcp_month_emails(emails: DataFrame) -> DataFrame:
    return (emails.select(*_keyed(emails, "customer_id", "email_date"),
                          "delivery_status", "opened_flag", "clicked_flag")
                  .groupBy(*KEYS).agg(*_email_measures()))


def _congress_measures() -> list[Column]:
    return [F.sum(flag(_is_true("invitation_sent"))).cast("bigint").alias("total_congress_invites"),
            F.sum(flag(_is_true("registered"))).cast("bigint").alias("total_congress_reg"),
            F.sum(flag(_is_true("attended"))).cast("bigint").alias("total_congress_attend")]


def hcp_month_congress(congress: DataFrame) -> DataFrame:
    return (congress.select(*_keyed(congress, "customer_id", "start_time"),
                            "invitation_sent", "registered", "attended")
                    .groupBy(*KEYS).agg(*_congress_measures()))


def _trx_by_text_id(prescriptions: DataFrame) -> DataFrame:
    """TRx per (prescriber text id, month, year): the eager pre-aggregate."""
    return (prescriptions.select(F.col("hcp_id").alias("hcp_code"), month_num("week").alias("month"),
                                 year_num("week").alias("year"), "trx_cnt")
                         .groupBy("hcp_code", "month", "year")
                         .agg(F.sum("trx_cnt").alias("total_trx")))


def _master_ids(master: DataFrame) -> DataFrame:
    return master.select(F.col("hcp_id").alias("hcp_code"), F.col("id").alias("hcp_id"))


def hcp_month_trx(prescriptions: DataFrame, master: DataFrame) -> DataFrame:
    """TRx per mapped HCP-month; unmapped prescribers form the NULL-id group.

    Summing before the join gives the reference's totals, including the
    fan-out when one text id has several master rows.
    """
    joined = _trx_by_text_id(prescriptions).join(_master_ids(master), "hcp_code", "left")
    return (joined.groupBy(*KEYS)
                  .agg(F.sum("total_trx").cast("bigint").alias("total_trx")))


def hcp_month_spine(calls: DataFrame, emails: DataFrame, congress: DataFrame,
                    prescriptions: DataFrame, master: DataFrame) -> DataFrame:
    """Distinct (hcp_id, month, year) over the four sources (NULL id kept)."""
    trx_keys = (prescriptions.select(F.col("hcp_id").alias("hcp_code"),
                                     month_num("week").alias("month"), year_num("week").alias("year"))
                             .distinct()
                             .join(_master_ids(master), "hcp_code", "left")
                             .select(*KEYS))
    parts = [calls.select(*_keyed(calls, "customer_id", "contact_date")),
             emails.select(*_keyed(emails, "customer_id", "email_date")),
             congress.select(*_keyed(congress, "customer_id", "start_time")),
             trx_keys]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.distinct()


# ---------------------------------------------------------------------- L1 exposure
VOLUMES = ["total_calls", "total_emails_sent", "total_emails_opened", "total_emails_clicked",
           "total_congress_invites", "total_congress_reg", "total_congress_attend", "total_trx"]


def _tagged_union(calls, emails, congress, prescriptions, master) -> DataFrame:
    """All channel rows on one schema; a column is NULL outside its channel.

    Calls enter already de-duplicated on (key, interaction_id), one row each,
    so the exposure aggregate needs no COUNT(DISTINCT) over all channel rows
    (which would shuffle every row twice).  Calls without an interaction id
    count 0 and can be left out: a key with nothing else is removed by the
    final filter anyway.  Keys with a NULL part are dropped up front.
    """
    none_l = F.lit(None).cast("bigint")
    none_b = F.lit(None).cast("boolean")
    none_s = F.lit(None).cast("string")

    def row(keys, n_calls=none_l, status=none_s, opened=none_b, clicked=none_b,
            invited=none_b, reg=none_b, attend=none_b, trx=none_l):
        return [*keys, n_calls.alias("n_calls"), status.alias("delivery_status"),
                opened.alias("opened_flag"), clicked.alias("clicked_flag"),
                invited.alias("invitation_sent"), reg.alias("registered"),
                attend.alias("attended"), trx.alias("trx")]

    def complete(df: DataFrame) -> DataFrame:
        return df.where(F.col("hcp_id").isNotNull() & F.col("month").isNotNull()
                        & F.col("year").isNotNull())

    distinct_calls = complete(
        calls.where(F.col("interaction_id").isNotNull())
             .select(*_keyed(calls, "customer_id", "contact_date"), "interaction_id")
    ).distinct()
    c = distinct_calls.select(*row(KEYS, n_calls=F.lit(1).cast("bigint")))
    e = complete(emails.select(*row(_keyed(emails, "customer_id", "email_date"),
                                    status=F.col("delivery_status"), opened=F.col("opened_flag"),
                                    clicked=F.col("clicked_flag"))))
    g = complete(congress.select(*row(_keyed(congress, "customer_id", "start_time"),
                                      invited=F.col("invitation_sent"), reg=F.col("registered"),
                                      attend=F.col("attended"))))
    t = complete(_trx_by_text_id(prescriptions)
                 .join(_master_ids(master), "hcp_code", "inner")   # unmapped rows never survive
                 .select(*row([F.col("hcp_id"), F.col("month"), F.col("year")],
                              trx=F.col("total_trx").cast("bigint"))))
    return c.unionByName(e).unionByName(g).unionByName(t)


def omni_exposure(calls: DataFrame, emails: DataFrame, congress: DataFrame,
                  prescriptions: DataFrame, master: DataFrame) -> DataFrame:
    rows = _tagged_union(calls, emails, congress, prescriptions, master)
    per_month = rows.groupBy(*KEYS).agg(
        F.sum("n_calls").alias("total_calls"),
        *_email_measures(), *_congress_measures(),
        F.sum("trx").alias("total_trx"))
    v = {name: F.coalesce(F.col(name), F.lit(0)).cast("bigint") for name in VOLUMES}
    per_month = per_month.select(*KEYS, *[v[n].alias(n) for n in VOLUMES])
    per_month = per_month.where(
        (F.col("total_calls") + F.col("total_emails_sent") + F.col("total_congress_invites") > 0)
        | (F.col("total_trx") > 0))
    m = master.select(F.col("id").alias("hcp_id"), "hco_id", "territory_id",
                      F.col("target_type").alias("tier"))
    joined = per_month.join(m, "hcp_id", "left")
    pos = lambda c: F.col(c) > 0
    flags = {
        "calls_reach_flag": pos("total_calls"),
        "calls_engagement_flag": pos("total_calls"),
        "calls_deep_engagement_flag": pos("total_calls"),
        "email_reach_flag": pos("total_emails_sent"),
        "email_engagement_flag": pos("total_emails_opened"),
        "email_deep_engagement_flag": pos("total_emails_clicked"),
        "congress_reach_flag": pos("total_congress_invites"),
        "congress_engagement_flag": pos("total_congress_reg"),
        "congress_deep_engagement_flag": pos("total_congress_attend"),
        "overall_reach_flag": pos("total_calls") | pos("total_emails_sent") | pos("total_congress_invites"),
        "overall_engagement_flag": pos("total_calls") | pos("total_emails_opened") | pos("total_congress_reg"),
        "overall_deep_engagement_flag": pos("total_calls") | pos("total_emails_clicked")
        | pos("total_congress_attend"),
    }
    return joined.select(*KEYS, "hco_id", "territory_id", "tier", *VOLUMES,
                         *[flag(c).alias(n) for n, c in flags.items()])


# ----------------------------------------------------------------- L2 performance
CHANNELS = [
    # (channel label, flag prefix, volume column)
    ("Calls", "calls", "total_calls"),
    ("Emails", "email", "total_emails_sent"),
    ("Congress", "congress", "total_congress_invites"),
]


def channel_long(exposure: DataFrame) -> DataFrame:
    """One row per HCP-month and channel (three channels plus 'OVERALL')."""
    def entry(label: str, prefix: str, volume: Column) -> Column:
        return F.struct(F.lit(label).alias("channel"),
                        F.col(f"{prefix}_reach_flag").alias("reach_flag"),
                        F.col(f"{prefix}_engagement_flag").alias("engagement_flag"),
                        F.col(f"{prefix}_deep_engagement_flag").alias("deep_engagement_flag"),
                        volume.cast("bigint").alias("channel_volume"))
    overall_volume = F.col("total_calls") + F.col("total_emails_sent") + F.col("total_congress_invites")
    entries = [entry(label, prefix, F.col(vol)) for label, prefix, vol in CHANNELS]
    entries.append(entry("OVERALL", "overall", overall_volume))
    return (exposure.select("month", "year", F.col("tier").alias("target_type"), "hcp_id",
                            "total_trx", F.inline(F.array(*entries)))
                    .select("month", "year", "target_type", "channel", "hcp_id", "reach_flag",
                            "engagement_flag", "deep_engagement_flag", "channel_volume",
                            "total_trx"))


L2_DIMS = ["month", "year", "target_type"]
L2_SETS = [["month", "year", "target_type"],
           ["month", "year"],
           ["year", "target_type"],
           ["year"]]
L2_CHANNELS = [(label, prefix) for label, prefix, _ in CHANNELS] + [("OVERALL", "overall")]
_PER_CHANNEL = ["reached_hcps", "engaged_hcps", "deep_engaged_hcps", "writers_reached",
                "writers_engaged", "writers_deep_engaged", "trx_from_reached", "trx_from_engaged",
                "trx_from_deep_engaged", "total_channel_volume"]


def omni_performance(exposure: DataFrame) -> DataFrame:
    """L2: reach, engagement and writer counts and TRx per level and channel.

    Levels: (month, year, target type), (month, year), (year, target type),
    (year), each per channel (three channels and OVERALL).  Instead of
    unpivoting every HCP-month into four channel rows and then expanding four
    levels (16 rows per HCP-month before the first shuffle), the channels
    travel as columns through both aggregation steps and are unpivoted only
    at the end, on the aggregated rows: 4 rows per HCP-month.  Distinct HCP
    counts use the two-step aggregate of ``rollup.py`` (first per level and
    HCP, keyed by the HCP, then summed per level).
    """
    writer = F.col("total_trx") > 0
    volumes = {"calls": F.col("total_calls"), "email": F.col("total_emails_sent"),
               "congress": F.col("total_congress_invites"),
               "overall": F.col("total_calls") + F.col("total_emails_sent") + F.col("total_congress_invites")}
    additive = {"total_trx": F.sum("total_trx")}
    reach = {"total_writers": writer}
    for _, p in L2_CHANNELS:
        flags = {"reached": F.col(f"{p}_reach_flag") == 1,
                 "engaged": F.col(f"{p}_engagement_flag") == 1,
                 "deep_engaged": F.col(f"{p}_deep_engagement_flag") == 1}
        for name, cond in flags.items():
            reach[f"{p}__{name}_hcps"] = cond
            reach[f"{p}__writers_{name}"] = cond & writer
            additive[f"{p}__trx_from_{name}"] = F.sum(F.when(cond, F.col("total_trx")).otherwise(F.lit(0)))
        additive[f"{p}__total_channel_volume"] = F.sum(volumes[p].cast("bigint"))
    base = exposure.withColumnRenamed("tier", "target_type")
    agg = grouping_sets_with_reach(base, L2_DIMS, L2_SETS, "hcp_id", additive, reach)
    per_channel = F.inline(F.array(*[
        F.struct(F.lit(label).alias("channel"),
                 *[F.col(f"{p}__{m}").alias(m) for m in _PER_CHANNEL])
        for label, p in L2_CHANNELS]))
    long = agg.select("_gid", *L2_DIMS, "total_trx", "total_writers", per_channel)
    r = lambda d: rolled(L2_DIMS, d)
    monthly = ~r("month")
    return long.select(
        F.when(monthly, F.lit("MONTHLY")).otherwise(F.lit("YEARLY")).alias("time_granularity"),
        "month", "year",
        F.when(r("target_type"), F.lit("ALL")).otherwise(F.col("target_type")).alias("target_type"),
        "channel",
        "reached_hcps", "engaged_hcps", "deep_engaged_hcps",
        "total_writers", "writers_reached", "writers_engaged", "writers_deep_engaged",
        *[F.col(c).cast("bigint").alias(c) for c in
          ("total_trx", "trx_from_reached", "trx_from_engaged", "trx_from_deep_engaged")],
        ratio_or_zero("total_channel_volume", "reached_hcps").alias("reach_frequency"),
    )
