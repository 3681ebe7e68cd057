"""Declared schemas of the eight inputs, and conforming user tables to them.

The reference reads warehouse tables whose DDL it does not ship; the types
below are inferred from how each column is used.  ``conform`` lets a user
point the package at their own tables (Parquet exports, catalog tables):
columns are matched case-insensitively (the reference's identifiers are
case-insensitive), cast to the declared types, and flags stored as text
('TRUE' / 'true' / 'False') become booleans, so a flag compared with TRUE in
one script and with 'TRUE' in another means the same thing everywhere.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

S, L, I, D, B, TS = (T.StringType(), T.LongType(), T.IntegerType(), T.DateType(),
                     T.BooleanType(), T.TimestampType())
MONEY = T.DecimalType(12, 2)

_FIELDS = {
    "hcp_master": [("id", L), ("hcp_id", S), ("hco_id", L), ("territory_id", I), ("target_type", S)],
    "prescriptions": [("hcp_id", S), ("territory_id", I), ("drug_class", S), ("week", D),
                      ("trx_cnt", L), ("trx_qty", L)],
    "calls": [("interaction_id", L), ("customer_id", L), ("contact_date", D), ("tier", S),
              ("call_type", S), ("call_duration", I)],
    "emails": [("customer_id", L), ("email_date", D), ("tier", S), ("email_type", S),
               ("subject_category", S), ("delivery_status", S), ("opened_flag", B),
               ("clicked_flag", B), ("reach_back", B)],
    "congress": [("customer_id", L), ("start_time", TS), ("tier", S), ("congress_name", S),
                 ("mode", S), ("invitation_sent", B), ("registered", B), ("attended", B),
                 ("booth_visit", B), ("post_congress_followup", B)],
    "paid_search": [("month", S), ("search_engine", S), ("campaign_id", L), ("campaign_name", S),
                    ("impressions", L), ("clicks", L), ("cost", MONEY)],
    "display": [("month", S), ("package", S), ("impressions", L), ("reach", L),
                ("viewable_impressions", L), ("clicks", L), ("cost", MONEY),
                ("post_view_sessions", L), ("post_click_sessions", L)],
    "website": [("month", S), ("source", S)] + [(c, L) for c in (
        "sessions", "engaged_sessions", "pageviews", "event_clicks", "event_form_submit",
        "event_downloads", "event_registrations", "scroll_25", "scroll_50", "scroll_75",
        "scroll_100")],
}

SCHEMAS: dict[str, T.StructType] = {
    name: T.StructType([T.StructField(c, t, True) for c, t in fields])
    for name, fields in _FIELDS.items()}


def conform(df: DataFrame, name: str) -> DataFrame:
    """Project ``df`` onto the declared schema of input ``name`` (a narrow select,
    so only the needed columns are read)."""
    by_lower = {c.lower(): c for c in df.columns}
    cols = []
    for field in SCHEMAS[name].fields:
        src = by_lower.get(field.name.lower())
        if src is None:
            raise ValueError(f"{name}: column {field.name} is missing")
        c = F.col(src)
        if isinstance(field.dataType, T.BooleanType) and isinstance(df.schema[src].dataType, T.StringType):
            c = F.upper(F.trim(c)).cast("boolean")
        cols.append(c.cast(field.dataType).alias(field.name))
    return df.select(*cols)


class TableInputs:
    """The eight inputs from user tables: ``{name: parquet path or table name}``.

    Exposes the same attributes as the fixture ``Inputs``, so
    every query of ``plans.catalog`` and the refresh job run on it.
    """

    def __init__(self, spark: SparkSession, sources: dict[str, str]):
        missing = set(SCHEMAS) - set(sources)
        if missing:
            raise ValueError(f"no source given for {sorted(missing)}")
        self.spark = spark
        self._sources = dict(sources)
        self._cache: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in SCHEMAS:
            raise AttributeError(name)
        if name not in self._cache:
            src = self._sources[name]
            raw = (self.spark.read.parquet(src) if "/" in src or src.endswith(".parquet")
                   else self.spark.table(src))
            self._cache[name] = conform(raw, name)
        return self._cache[name]
