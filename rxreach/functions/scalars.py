"""Column-expression helpers (all built-in, codegen-friendly, no UDF)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ratio_or_zero(num: str | Column, den: str | Column) -> Column:
    """``CASE WHEN den > 0 THEN num / den ELSE 0 END`` as DOUBLE.

    Exact integer/decimal sums are cast to double only here, at the end, so
    the division is the same IEEE operation in every engine.
    """
    n, d = col(num), col(den)
    return (F.when(d > 0, n.cast("double") / d.cast("double"))
             .otherwise(F.lit(0.0)))


def ratio(num: str | Column, den: str | Column) -> Column:
    """Unguarded ``num / den`` as DOUBLE (ANSI mode raises on a zero divisor)."""
    return col(num).cast("double") / col(den).cast("double")


def month_start_from_text(c: str | Column) -> Column:
    """``TO_DATE(text, 'YYYY-MM')``: first day of that month (bad text raises)."""
    return F.to_date(col(c), "yyyy-MM")


def month_start(c: str | Column) -> Column:
    """``DATE_TRUNC('MONTH', d)`` that stays a DATE."""
    return F.trunc(F.to_date(col(c)), "month")


def month_num(c: str | Column) -> Column:
    return F.month(F.to_date(col(c))).cast("int")


def year_num(c: str | Column) -> Column:
    return F.year(F.to_date(col(c))).cast("int")


def flag(cond: Column) -> Column:
    """``CASE WHEN cond THEN 1 ELSE 0 END`` (NULL counts as false)."""
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


def label_all(value: str | Column, is_rolled: Column, label: str = "ALL") -> Column:
    """Dimension value, or the 'ALL' label on rolled-up levels."""
    return F.when(is_rolled, F.lit(label)).otherwise(col(value))
