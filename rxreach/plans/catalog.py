"""Named queries: each key builds one output table from a data folder.

Every callable takes ``(spark, sf_dir)`` and returns a DataFrame over the whole
input tables: lazy, but for derived tables that a query needs more than once,
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..functions.once import once
from ..operators import behavior as B
from ..operators import channels as C
from ..operators import extensions as X
from ..operators import hco as H
from ..operators import omni as O
from ..sources import Inputs

Query = Callable[[SparkSession, str], DataFrame]


def _exposure(i: Inputs) -> DataFrame:
    return O.omni_exposure(i.calls, i.emails, i.congress, i.prescriptions, i.hcp_master)


def _summary(i: Inputs) -> DataFrame:
    return B.hcp_summary(i.prescriptions, i.hcp_master)


def _weekly(i: Inputs) -> DataFrame:
    """The HCO chain's pre-aggregate."""
    return H.weekly_trx(i.prescriptions)


def _affiliated(i: Inputs, weekly: DataFrame | None = None) -> DataFrame:
    return H.affiliated_trx(_weekly(i) if weekly is None else weekly, i.hcp_master)


def _hco_summary(i: Inputs) -> DataFrame:
    return H.hco_summary(_affiliated(i))


# Where several branches need a table it is written once (the refresh job's order in
# small): the raw prescriptions are read by one job per query.
def _high_value(i: Inputs) -> DataFrame:
    return H.high_value_hco(once(_hco_summary(i)))


def _with_high_value(i: Inputs) -> tuple[DataFrame, DataFrame, DataFrame]:
    weekly = once(_weekly(i))
    affiliated = _affiliated(i, weekly)
    return weekly, affiliated, H.high_value_hco(once(H.hco_summary(affiliated)))


def _high_value_territory(i: Inputs) -> DataFrame:
    _, affiliated, high_value = _with_high_value(i)
    return H.high_value_hco_territory(affiliated, high_value)


def _territory_high_value(i: Inputs) -> DataFrame:
    _, affiliated, high_value = _with_high_value(i)
    return H.territory_high_value_trx(affiliated, high_value)


def _dependency_risk(i: Inputs) -> DataFrame:
    weekly, affiliated, high_value = _with_high_value(i)
    return H.dependency_risk(H.territory_high_value_trx(affiliated, high_value),
                             H.territory_totals(weekly, i.hcp_master))


def _hco_growth(i: Inputs) -> DataFrame:
    weekly = once(_weekly(i))
    return X.hco_growth_segment(_affiliated(i, weekly), weekly)


BUILDERS: dict[str, Callable[[Inputs], DataFrame]] = {
    # L1 channel rollups
    "call_rollup": lambda i: C.call_rollup(i.calls),
    "email_rollup": lambda i: C.email_rollup(i.emails),
    "congress_rollup": lambda i: C.congress_rollup(i.congress),
    "paid_search_rollup": lambda i: C.paid_search_rollup(i.paid_search),
    "display_rollup": lambda i: C.display_rollup(i.display),
    "website_rollup": lambda i: C.website_rollup(i.website),
    "trx_rollup": lambda i: C.trx_rollup(i.prescriptions),
    # omni integration
    "hcp_month_spine": lambda i: O.hcp_month_spine(i.calls, i.emails, i.congress,
                                                   i.prescriptions, i.hcp_master),
    "hcp_month_calls": lambda i: O.hcp_month_calls(i.calls),
    "hcp_month_emails": lambda i: O.hcp_month_emails(i.emails),
    "hcp_month_congress": lambda i: O.hcp_month_congress(i.congress),
    "hcp_month_trx": lambda i: O.hcp_month_trx(i.prescriptions, i.hcp_master),
    "omni_exposure": _exposure,
    "channel_long": lambda i: O.channel_long(_exposure(i)),
    "omni_performance": lambda i: O.omni_performance(_exposure(i)),
    # prescriber behaviour
    "hcp_writing_analysis": lambda i: B.hcp_writing_analysis(i.prescriptions, i.hcp_master),
    "trx_week_bounds": lambda i: B.trx_week_bounds(i.prescriptions),
    "trx_base": lambda i: B.trx_base(i.prescriptions, i.hcp_master),
    "hcp_summary": _summary,
    "monthly_active_hcps": lambda i: B.monthly_active_hcps(i.prescriptions),
    "cohort_analysis": lambda i: B.cohort_analysis(_summary(i)),
    "hcp_behavior": lambda i: B.hcp_behavior(_summary(i), i.hcp_master),
    "tier_behavior_matrix": lambda i: B.tier_behavior_matrix(B.hcp_behavior(_summary(i), i.hcp_master)),
    "territory_ranking": lambda i: B.territory_ranking(i.prescriptions, i.hcp_master),
    "growth_funnel": lambda i: B.growth_funnel(_summary(i)),
    # HCO and dependency
    "hco_base": lambda i: H.hco_base(i.prescriptions, i.hcp_master),
    "hco_summary": _hco_summary,
    "hco_value_cutoff": lambda i: H.hco_value_cutoff(_hco_summary(i)),
    "high_value_hco": _high_value,
    "hco_concentration": lambda i: H.hco_concentration(_high_value(i)),
    "high_value_hco_territory": _high_value_territory,
    "territory_totals": lambda i: H.territory_totals(_weekly(i), i.hcp_master),
    "territory_high_value_trx": _territory_high_value,
    "dependency_risk": _dependency_risk,
    "hcp_retention_rate": lambda i: X.hcp_retention_rate(i.prescriptions),
    "churn_indicators": lambda i: X.churn_indicators(i.prescriptions),
    "hco_adoption": lambda i: X.hco_adoption(_affiliated(i)),
    "hco_growth_segment": _hco_growth,
    "territory_promo_vs_trx": lambda i: X.territory_promo_vs_trx(_exposure(i)),
    "channel_effectiveness": lambda i: X.channel_effectiveness(_exposure(i)),
    "channel_effectiveness_by_tier": lambda i: X.channel_effectiveness_by_tier(_exposure(i)),
    "channel_mix": lambda i: X.channel_mix(_exposure(i)),
    "contact_frequency": lambda i: X.contact_frequency(_exposure(i)),
    "opportunity_territories": lambda i: X.opportunity_territories(_exposure(i)),
    "hcp_concentration": lambda i: X.hcp_concentration(once(_summary(i))),
    "engagement_trx_correlation": lambda i: X.engagement_trx_correlation(_exposure(i)),
}


def build(spark: SparkSession, sf_dir: str, key: str) -> DataFrame:
    return BUILDERS[key](Inputs(spark, sf_dir))


def queries() -> dict[str, Query]:
    return {key: (lambda spark, sf_dir, _k=key: build(spark, sf_dir, _k)) for key in BUILDERS}
