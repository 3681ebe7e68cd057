"""Derived tables that a query needs more than once."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from ..session import ensure_checkpoint_dir


def once(df: DataFrame) -> DataFrame:
    """``df`` computed now, written as Parquet under the session's checkpoint
    folder (``spark.checkpoint.dir``, shared by all executors) and read back.

    What follows reads the written columns it needs, as often as it likes; the
    inputs are read once, and a lost executor recomputes from the files.  They
    stay until that folder is cleaned, as other readers may still need them.
    """
    path = f"{ensure_checkpoint_dir(df.sparkSession)}/once-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
