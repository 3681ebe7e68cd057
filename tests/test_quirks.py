"""Reference quirks on hand-built inputs (cases the driver's tables do not reach).

Each case is checked twice: against the literal SQL oracle run by DuckDB on
the same rows, and against values worked out by hand.
"""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.errors import ArithmeticException

from handmade import Case

W1, W2, W3 = dt.date(2025, 1, 6), dt.date(2025, 1, 13), dt.date(2025, 2, 3)


# ------------------------------------------------------------------ master fan-out
@pytest.fixture(scope="module")
def fanout(spark, tmp_path_factory):
    """One text id with two master rows (two ids, two tiers, two HCOs)."""
    return Case(
        spark, tmp_path_factory.mktemp("fanout"),
        hcp_master=[(1, "N1", 10, 5, "Tier 1"), (2, "N1", 11, 5, "Tier 2"),
                    (3, "N3", None, 6, None)],
        prescriptions=[("N1", 5, "A", W1, 1, 30), ("N1", 5, "A", W2, 2, 60),
                       ("N1", 7, "R", W3, 3, 90),
                       ("N3", 6, "A", W1, 4, 120), ("N9", None, "A", W2, 5, 150)],
    )


BEHAVIOUR_KEYS = ["trx_base", "hcp_summary", "hcp_writing_analysis", "hcp_behavior",
                  "tier_behavior_matrix", "territory_ranking", "growth_funnel", "cohort_analysis",
                  "monthly_active_hcps", "trx_week_bounds", "hco_base", "hco_summary",
                  "hco_value_cutoff", "high_value_hco", "hco_concentration",
                  "high_value_hco_territory", "territory_totals", "territory_high_value_trx",
                  "dependency_risk", "hcp_month_trx", "hcp_month_spine", "trx_rollup"]


@pytest.mark.parametrize("key", BEHAVIOUR_KEYS)
def test_fanout_matches_literal_sql(fanout, key):
    fanout.check(key)


def test_fanout_doubles_sums_not_distincts(fanout):
    s = {r["hcp_id"]: r for r in fanout.rows("hcp_summary")}
    assert s["N1"]["total_trx"] == 12          # (1 + 2 + 3) x 2 master rows
    assert s["N1"]["weeks_active"] == 3
    assert s["N1"]["avg_trx"] == 2.0
    assert s["N9"]["total_trx"] == 5            # unmapped: kept once
    beh = sorted((r["hcp_id"], r["tier"]) for r in fanout.rows("hcp_behavior"))
    assert beh == [("N1", "Tier 1"), ("N1", "Tier 2"), ("N3", None), ("N9", None)]
    hco = {r["hco_id"]: r for r in fanout.rows("hco_summary")}
    assert hco[10]["total_trx"] == 12 and hco[11]["total_trx"] == 12   # double join
    assert hco[10]["territory_spread"] == 2
    assert len(fanout.rows("hco_base")) == 12


# --------------------------------------------------------------- rank NULL order
def test_rank_puts_null_totals_first(spark, tmp_path):
    case = Case(spark, tmp_path,
                prescriptions=[("N1", 1, "A", W1, 10, 1), ("N2", 2, "A", W1, 20, 1),
                               ("N3", 3, "A", W1, None, 1), ("N4", 2, "A", W2, None, 1)])
    case.check("territory_ranking")
    r = {x["territory_id"]: x for x in case.rows("territory_ranking")}
    assert r[3]["total_trx"] is None and r[3]["territory_rank"] == 1
    assert (r[2]["territory_rank"], r[1]["territory_rank"]) == (2, 3)
    assert r[2]["writing_hcps"] == 2


def test_rank_ties_share_a_rank(spark, tmp_path):
    case = Case(spark, tmp_path,
                prescriptions=[("N1", 1, "A", W1, 10, 1), ("N2", 2, "A", W1, 10, 1),
                               ("N3", 3, "A", W1, 5, 1)])
    r = {x["territory_id"]: x["territory_rank"] for x in case.rows("territory_ranking")}
    assert r == {1: 1, 2: 1, 3: 3}


# ------------------------------------------------- NULL dates, flags and tiers
@pytest.fixture(scope="module")
def channels(spark, tmp_path_factory):
    t = dt.datetime
    return Case(
        spark, tmp_path_factory.mktemp("channels"),
        hcp_master=[(1, "N1", 10, 5, "Tier 1"), (2, "N2", 11, 5, None)],
        calls=[(100, 1, dt.date(2025, 3, 4), "Tier 1", "F2F", 15),
               (101, 1, dt.date(2025, 3, 9), "Tier 1", "F2F", 30),
               (101, 1, dt.date(2025, 3, 9), "Tier 1", "F2F", 30),      # same interaction twice
               (102, 2, dt.date(2024, 3, 1), None, "Phone", None),
               (None, 2, dt.date(2025, 4, 1), None, "Phone", 45),
               (103, 9, None, "Tier 2", "Remote", 15)],
        emails=[(1, dt.date(2025, 3, 2), "Tier 1", "HQ", "S0", "Delivered", True, None, None),
                (2, dt.date(2025, 5, 2), None, "RTE", "S1", "Bounced", None, None, False),
                (2, None, None, "RTE", "S1", "Delivered", True, True, True),
                (1, dt.date(2024, 3, 2), "Tier 1", "HQ", "S2", "Pending", False, False, None)],
        congress=[(1, t(2025, 3, 5, 10), "Tier 1", "C1", "Virtual", True, True, True, None, None),
                  (2, t(2025, 6, 1), None, "C2", "In-Person", False, True, None, True, True),
                  (2, None, None, "C2", "Virtual", True, False, False, False, False),
                  (None, t(2025, 6, 1), "Tier 3", "C3", "Virtual", True, True, True, True, True)],
        prescriptions=[("N1", 5, "A", dt.date(2025, 3, 3), 4, 1),
                       ("N2", 5, "A", dt.date(2025, 5, 5), 0, 1),
                       ("N7", 5, "A", dt.date(2025, 6, 2), 9, 1)],
    )


OMNI_KEYS = ["call_rollup", "email_rollup", "congress_rollup", "hcp_month_spine",
             "hcp_month_calls", "hcp_month_emails", "hcp_month_congress", "hcp_month_trx",
             "omni_exposure", "channel_long", "omni_performance"]


@pytest.mark.parametrize("key", OMNI_KEYS)
def test_channels_match_literal_sql(channels, key):
    channels.check(key)


def test_null_tier_is_its_own_group(channels):
    rows = channels.rows("email_rollup")
    tier_rows = [r for r in rows if r["sub_granularity"] == "TIER"]
    assert any(r["sub_granularity_value"] is None for r in tier_rows)
    assert all(r["sub_granularity_value"] != "ALL" for r in tier_rows)


def test_monthly_duration_is_nulled_only_on_the_type_level(channels):
    rows = channels.rows("call_rollup")
    month_type = [r for r in rows if r["time_granularity"] == "MONTH" and r["tier"] == "ALL"
                  and r["call_type"] != "ALL"]
    year_type = [r for r in rows if r["time_granularity"] == "YEAR" and r["tier"] == "ALL"
                 and r["call_type"] != "ALL"]
    assert month_type and all(r["call_duration"] is None for r in month_type)
    assert any(r["call_duration"] is not None for r in year_type)
    # one month row per duration, durations nulled: equal visible keys repeat
    keys = [(r["period"], r["call_type"]) for r in month_type]
    assert len(keys) > len(set(keys))


def test_exposure_drops_bounced_only_and_unmapped(channels):
    rows = channels.rows("omni_exposure")
    keys = {(r["hcp_id"], r["month"], r["year"]) for r in rows}
    assert (2, 5, 2025) not in keys      # only a bounced mail and TRx 0 that month
    assert (1, 3, 2025) in keys
    assert all(r["hcp_id"] is not None for r in rows)   # unmapped N7 vanished
    r = next(x for x in rows if (x["hcp_id"], x["month"], x["year"]) == (1, 3, 2025))
    assert r["total_calls"] == 2 and r["total_trx"] == 4 and r["overall_reach_flag"] == 1


# ----------------------------------------------------------- errors are kept
def test_bad_month_text_raises(spark, tmp_path):
    case = Case(spark, tmp_path,
                paid_search=[("2025/03", "Google", 1, "Camp 1", 10, 1, Decimal("1.00"))])
    # both levels hang on the exchange that fails, so the exception may come wrapped
    with pytest.raises(Exception, match="CANNOT_PARSE_TIMESTAMP.*2025/03"):
        case.spark_df("paid_search_rollup").collect()


def test_zero_territory_total_raises(spark, tmp_path):
    case = Case(spark, tmp_path,
                hcp_master=[(1, "N1", 10, 5, "Tier 1")],
                prescriptions=[("N1", 5, "A", W1, 0, 1)])
    with pytest.raises(ArithmeticException):
        case.spark_df("dependency_risk").collect()


def test_zero_denominators_give_zero_ratios(spark, tmp_path):
    case = Case(spark, tmp_path,
                paid_search=[("2025-03", "Google", 1, "Camp 1", 0, 0, Decimal("3.50"))],
                display=[("2025-03", "Pkg 1", 0, 0, 0, 0, Decimal("2.00"), 1, 0)])
    for key in ("paid_search_rollup", "display_rollup"):
        case.check(key)
    ps = case.rows("paid_search_rollup")
    assert len(ps) == 2 and all(r["ctr"] == 0.0 and r["avg_cpc"] == 0.0 for r in ps)
    assert all(r["cpm"] == 0.0 and r["frequency"] == 0.0 for r in case.rows("display_rollup"))


def test_percentile_tie_is_high_value(spark, tmp_path):
    # HCO totals 10, 20, 30, 40, 50: the 75th percentile is exactly 40
    master = [(i, f"N{i}", 100 + i, 1, "Tier 1") for i in range(1, 6)]
    trx = [(f"N{i}", 1, "A", W1, 10 * i, 1) for i in range(1, 6)]
    case = Case(spark, tmp_path, hcp_master=master, prescriptions=trx)
    case.check("high_value_hco")
    cutoff = case.rows("hco_value_cutoff")[0]["trx_cutoff"]
    assert cutoff == 40.0
    seg = {r["hco_id"]: r["hco_segment"] for r in case.rows("high_value_hco")}
    assert seg == {101: "NORMAL", 102: "NORMAL", 103: "NORMAL", 104: "HIGH_VALUE", 105: "HIGH_VALUE"}


def test_ytd_rows_repeat_per_year(spark, tmp_path):
    case = Case(spark, tmp_path,
                website=[("2024-05", "Paid") + (1,) * 11, ("2025-05", "Paid") + (2,) * 11])
    case.check("website_rollup")
    ytd = [r for r in case.rows("website_rollup") if r["time_granularity"] == "YTD"]
    assert len(ytd) == 2 and all(r["period"] is None for r in ytd)


# ------------------------------------------------------- one key holds a third
@pytest.fixture(scope="module")
def hot(spark, tmp_path_factory):
    """Prescriber N1 and HCP 1 hold a third of all rows; master has a duplicate."""
    rows, calls, emails = [], [], []
    for k in range(600):
        hcp = 1 if k % 3 == 0 else 2 + k % 40
        week = dt.date(2025, 1, 6) + dt.timedelta(weeks=k % 50)
        rows.append((f"N{hcp}", hcp % 7, "AR"[k % 2], week, k % 20 + 1, 30))
        calls.append((10_000 + k // 2, hcp, week, "Tier 1" if hcp % 2 else None, "F2F", 15 * (k % 3)))
        emails.append((hcp, week, None, "HQ", f"S{k % 3}", ("Delivered", "Bounced")[k % 5 == 0],
                       k % 2 == 0, k % 4 == 0, None))
    master = [(h, f"N{h}", 100 + h % 5, h % 7, ("Tier 1", "Tier 2", None)[h % 3]) for h in range(1, 42)]
    master.append((1, "N1", 200, 3, "Tier 3"))
    return Case(spark, tmp_path_factory.mktemp("hot"), hcp_master=master,
                prescriptions=rows, calls=calls, emails=emails)


@pytest.mark.parametrize("key", ["hcp_summary", "territory_ranking", "hco_summary", "dependency_risk",
                                 "omni_exposure", "omni_performance", "call_rollup", "email_rollup",
                                 "hcp_concentration", "hcp_retention_rate", "hco_adoption"])
def test_hot_key_matches_literal_sql(hot, key):
    hot.check(key)
