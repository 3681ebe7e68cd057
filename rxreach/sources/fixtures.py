"""The eight input tables, derived from the driver's TPC-H-like parquet.

The reference reads warehouse tables (prescriptions, HCP master and six
promotion channels) that ship with no data.  Each input is defined here once,
as SQL expression text, and that same text is used twice: by Spark
(``selectExpr``/``where``) and by the DuckDB oracle (``oracle_ctes``), so the
two engines start from identical inputs.

Fixed values (fixture definitions shared with the test oracle):

    FOLD(c)   make_date(2024 + year(c) % 2, month(c), least(day(c), 28))
    TIER      AUTOMOBILE -> Tier 1, BUILDING -> Tier 2, FURNITURE -> Tier 3,
              MACHINERY -> Non-Target, anything else -> NULL
    MON       '2024-'/'2025-' by event_id % 24 < 12, then month event_id % 12 + 1
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from . import tables as _tables

FOLD = "make_date(2024 + year({c}) % 2, month({c}), least(day({c}), 28))"
TIER = ("case c_mktsegment when 'AUTOMOBILE' then 'Tier 1' when 'BUILDING' then 'Tier 2' "
        "when 'FURNITURE' then 'Tier 3' when 'MACHINERY' then 'Non-Target' end")
MON = ("concat(case when event_id % 24 < 12 then '2024-' else '2025-' end, "
       "lpad(cast(event_id % 12 + 1 as string), 2, '0'))")


def _fold(c: str) -> str:
    return FOLD.format(c=c)


@dataclass(frozen=True)
class Fixture:
    """One input table: source join, row filter, projected expressions."""

    name: str
    sources: tuple[str, ...]          # base tables, joined in order
    join_keys: tuple[tuple[str, str], ...]   # (left col, right col) per join
    source_cols: dict[str, tuple[str, ...]]  # pruned columns per base table
    pre: tuple[tuple[str, str], ...]  # helper columns computed before the filter
    where: str | None
    columns: tuple[tuple[str, str], ...]     # output (name, expression)


HCP_MASTER = Fixture(
    name="hcp_master",
    sources=("customer",),
    join_keys=(),
    source_cols={"customer": ("c_custkey", "c_nationkey", "c_mktsegment")},
    pre=(),
    where=None,
    columns=(
        # one customer in 50 is in no fact table under these ids (an unmapped prescriber)
        ("id", "case when c_custkey % 50 = 7 then -c_custkey else c_custkey end"),
        ("hcp_id", "concat(case when c_custkey % 50 = 7 then 'X' else 'N' end, cast(c_custkey as string))"),
        ("hco_id", "case when c_custkey % 9 = 0 then null "
                   "when c_nationkey % 4 = 0 then cast(1000 + c_nationkey as bigint) "
                   "else cast(c_custkey % (13 + c_custkey % 61) as bigint) end"),
        ("territory_id", "c_nationkey"),
        ("target_type", TIER),
    ),
)

PRESCRIPTIONS = Fixture(
    name="prescriptions",
    sources=("lineitem", "orders", "customer"),
    join_keys=(("l_orderkey", "o_orderkey"), ("o_custkey", "c_custkey")),
    source_cols={"lineitem": ("l_orderkey", "l_quantity", "l_returnflag", "l_shipdate"),
                 "orders": ("o_orderkey", "o_custkey"),
                 "customer": ("c_custkey", "c_nationkey")},
    # a fifth of the prescribers stop by June 2025, a fifth start in June 2025: their months are folded
    pre=(("week", "cast(date_trunc('week', make_date("
                  "case when c_custkey % 5 = 1 then 2025 else 2024 + year(l_shipdate) % 2 end, "
                  "case when c_custkey % 5 = 1 then 6 + month(l_shipdate) % 7 "
                  "when c_custkey % 5 = 0 and year(l_shipdate) % 2 = 1 then (month(l_shipdate) - 1) % 6 + 1 "
                  "else month(l_shipdate) end, least(day(l_shipdate), 28))) as date)"),),
    where=None,
    columns=(
        ("hcp_id", "concat('N', cast(c_custkey as string))"),
        ("territory_id", "nullif(c_nationkey, 13)"),
        ("drug_class", "l_returnflag"),
        ("week", "week"),
        ("trx_cnt", "cast(floor(l_quantity) as bigint) % 20 + 1"),
        ("trx_qty", "cast(floor(l_quantity) as bigint) * 30"),
    ),
)

_ORDERS_CUSTOMER = dict(
    sources=("orders", "customer"),
    join_keys=(("o_custkey", "c_custkey"),),
    source_cols={"orders": ("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate",
                            "o_orderpriority"),
                 "customer": ("c_custkey", "c_mktsegment")},
    pre=(),
)

CALLS = Fixture(
    name="calls",
    where="o_orderstatus = 'F'",
    columns=(
        ("interaction_id", "o_orderkey"),
        ("customer_id", "o_custkey"),
        ("contact_date", _fold("o_orderdate")),
        ("tier", TIER),
        ("call_type", "case o_orderpriority when '1-URGENT' then 'F2F' "
                      "when '2-HIGH' then 'F2F' when '3-MEDIUM' then 'Remote' else 'Phone' end"),
        ("call_duration", "case o_orderkey % 4 when 0 then 15 when 1 then 30 when 2 then 45 end"),
    ),
    **_ORDERS_CUSTOMER,
)

EMAILS = Fixture(
    name="emails",
    where="o_orderstatus = 'O'",
    columns=(
        ("customer_id", "o_custkey"),
        ("email_date", _fold("o_orderdate")),
        ("tier", TIER),
        ("email_type", "case o_orderpriority when '1-URGENT' then 'RTE' else 'HQ' end"),
        ("subject_category", "concat('S', cast(o_orderkey % 3 as string))"),
        ("delivery_status", "case when o_orderkey % 10 < 7 then 'Delivered' "
                            "when o_orderkey % 10 = 7 then 'Bounced' else 'Pending' end"),
        ("opened_flag", "o_orderkey % 10 < 4"),
        ("clicked_flag", "o_orderkey % 10 < 2"),
        ("reach_back", "case when o_orderkey % 10 < 7 then o_orderkey % 10 = 0 end"),
    ),
    **_ORDERS_CUSTOMER,
)

CONGRESS = Fixture(
    name="congress",
    where="o_orderstatus = 'P'",
    columns=(
        ("customer_id", "o_custkey"),
        ("start_time", f"cast({_fold('o_orderdate')} as timestamp)"),
        ("tier", TIER),
        ("congress_name", "concat('C', cast(o_orderkey % 6 as string))"),
        ("mode", "case when o_orderkey % 2 = 0 then 'In-Person' else 'Virtual' end"),
        ("invitation_sent", "o_orderkey % 5 <> 0"),
        ("registered", "o_orderkey % 5 < 3"),
        ("attended", "o_orderkey % 5 = 1"),
        ("booth_visit", "o_orderkey % 10 = 1"),
        ("post_congress_followup", "o_orderkey % 20 = 1"),
    ),
    **_ORDERS_CUSTOMER,
)

_EVENTS = dict(sources=("events",), join_keys=(), pre=(),
               source_cols={"events": ("event_id", "user_id", "value")})

PAID_SEARCH = Fixture(
    name="paid_search",
    where=None,
    columns=(
        ("month", MON),
        ("search_engine", "case user_id % 3 when 0 then 'Google' when 1 then 'Bing' else 'Yahoo' end"),
        ("campaign_id", "user_id % 7"),
        ("campaign_name", "concat('Camp ', cast(user_id % 7 as string))"),
        ("impressions", "case when user_id % 7 = 6 then 0 else cast(floor(value * 100) as bigint) end"),
        ("clicks", "case when user_id % 7 >= 5 then 0 else cast(floor(value) as bigint) end"),
        ("cost", "cast(value as decimal(12,2))"),
    ),
    **_EVENTS,
)

DISPLAY = Fixture(
    name="display",
    where=None,
    columns=(
        ("month", MON),
        ("package", "concat('Pkg ', cast(user_id % 5 as string))"),
        ("impressions", "case when user_id % 5 = 4 then 0 else cast(floor(value * 100) as bigint) end"),
        ("reach", "case when user_id % 5 >= 3 then 0 else cast(floor(value * 10) as bigint) end"),
        ("viewable_impressions",
         "case when user_id % 5 = 4 then 0 else cast(floor(value * 60) as bigint) end"),
        ("clicks", "case when user_id % 5 >= 2 then 0 else cast(floor(value) as bigint) end"),
        ("cost", "cast(value as decimal(12,2))"),
        ("post_view_sessions", "cast(floor(value) as bigint)"),
        ("post_click_sessions", "cast(floor(value / 2) as bigint)"),
    ),
    **_EVENTS,
)

WEBSITE = Fixture(
    name="website",
    where=None,
    columns=(
        ("month", MON),
        ("source", "case user_id % 4 when 0 then 'Organic' when 1 then 'Paid' "
                   "when 2 then 'Direct' else 'Referral' end"),
        ("sessions", "cast(floor(value) as bigint)"),
        ("engaged_sessions", "cast(floor(value / 2) as bigint)"),
        ("pageviews", "cast(floor(value * 3) as bigint)"),
        ("event_clicks", "event_id % 5"),
        ("event_form_submit", "event_id % 3"),
        ("event_downloads", "event_id % 2"),
        ("event_registrations", "event_id % 7"),
        ("scroll_25", "user_id % 11"),
        ("scroll_50", "user_id % 7"),
        ("scroll_75", "user_id % 5"),
        ("scroll_100", "user_id % 3"),
    ),
    **_EVENTS,
)

FIXTURES: dict[str, Fixture] = {f.name: f for f in (
    HCP_MASTER, PRESCRIPTIONS, CALLS, EMAILS, CONGRESS, PAID_SEARCH, DISPLAY, WEBSITE)}


def build(spark: SparkSession, sf_dir: str, fx: Fixture) -> DataFrame:
    """Spark side: pruned scans, equi-joins, pushed-down filter, projection."""
    frames = [_tables.read(spark, sf_dir, t, fx.source_cols[t]) for t in fx.sources]
    df = frames[0]
    for right, (lk, rk) in zip(frames[1:], fx.join_keys):
        df = df.join(right, df[lk] == right[rk], "inner")
    if fx.pre:
        df = df.selectExpr("*", *[f"{e} AS {n}" for n, e in fx.pre])
    if fx.where:
        df = df.where(fx.where)
    return df.selectExpr(*[f"{e} AS {n}" for n, e in fx.columns])


def oracle_cte(fx: Fixture) -> str:
    """DuckDB side: the same expressions as one CTE body."""
    frm = fx.sources[0]
    for t, (lk, rk) in zip(fx.sources[1:], fx.join_keys):
        frm += f" JOIN {t} ON {lk} = {rk}"
    inner = f"SELECT *{''.join(f', {e} AS {n}' for n, e in fx.pre)} FROM {frm}"
    where = f" WHERE {fx.where}" if fx.where else ""
    cols = ", ".join(f"{e} AS {n}" for n, e in fx.columns)
    return f"{fx.name} AS (SELECT {cols} FROM ({inner}) _s{where})"


def oracle_ctes() -> str:
    return ",\n".join(oracle_cte(fx) for fx in FIXTURES.values())


class Inputs:
    """Lazily built input frames for one data folder (each built once)."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self._cache: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in FIXTURES:
            raise AttributeError(name)
        if name not in self._cache:
            self._cache[name] = build(self.spark, self.sf_dir, FIXTURES[name])
        return self._cache[name]
