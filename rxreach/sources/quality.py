"""Checks of the HCP master while it is used.

The reference joins every prescription to the master on ``hcp_id`` and takes
``id`` for the channels' customer; an id on two master rows repeats TRx without
a word.  The counts below are observed on the pass that builds the table of
master rows per prescriber, which the other tables need anyway: no scan or job
of its own.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


class MasterError(ValueError):
    """The master has duplicate or missing ids."""


def checked_multiplicity(master: DataFrame) -> tuple[DataFrame, Callable[[], dict[str, int]]]:
    """(hcp_id, mult) as ``behavior.multiplicity``, and a function that tells,
    once that table has been computed: duplicate_hcp_id and duplicate_id (master
    rows beyond the first of their id), null_hcp_id and null_id (rows).

    Both ids are counted by one aggregate over grouping sets; the rows of ``id``
    are dropped behind the observation.
    """
    seen = Observation()
    counts = (master.select("hcp_id", "id").groupingSets([["hcp_id"], ["id"]], "hcp_id", "id")
              .agg(F.grouping("hcp_id").alias("_by_id"), F.count(F.lit(1)).alias("mult")))
    by_id = F.col("_by_id") == 1
    def rows(which, key: str, null: bool):
        k = F.col(key)
        over = F.when(which & k.isNull(), F.col("mult")) if null else F.when(which & k.isNotNull(), F.col("mult") - 1)
        return F.coalesce(F.sum(over), F.lit(0))
    counts = counts.observe(
        seen, rows(~by_id, "hcp_id", False).alias("duplicate_hcp_id"), rows(by_id, "id", False).alias("duplicate_id"),
        rows(~by_id, "hcp_id", True).alias("null_hcp_id"), rows(by_id, "id", True).alias("null_id"))
    return counts.where(~by_id).select("hcp_id", "mult"), lambda: dict(seen.get)
