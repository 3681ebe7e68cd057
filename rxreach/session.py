"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.errors import PySparkAttributeError
from pyspark.sql import SparkSession


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "rxreach") -> SparkSession:
    """A session tuned for this workload.

    On a cluster pass ``master=None`` and let the launcher decide; size
    ``spark.sql.shuffle.partitions`` to roughly (shuffle bytes / 128 MB) and
    leave AQE on so it coalesces small partitions and splits skewed ones.
    """
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if master is not None and master.startswith("local"):
        # a single machine; on a cluster these are the launcher's to set
        conf.setdefault("spark.sql.shuffle.partitions", os.environ.get("BENCH_CPUS", "8"))
        conf["spark.driver.memory"] = "16g"
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, setting one only when unset.

    On a cluster ``spark.checkpoint.dir`` must name a shared folder (HDFS,
    object store); it is read from the session and never replaced.  Only a
    local-mode session (tests, laptop) without that setting gets a fresh
    temporary folder.
    """
    try:
        sc = spark.sparkContext
    except PySparkAttributeError:      # Spark Connect has no context: the server's setting applies
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if not configured:
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on the server") from None
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="rxreach-ckpt-"))
    return sc.getCheckpointDir()
