"""Session construction and shared-storage helpers."""

from __future__ import annotations

import os
import tempfile

from pyspark import SparkConf
from pyspark.sql import SparkSession

# Settings every job relies on. AQE re-plans joins from runtime sizes, coalesces small
# shuffle partitions and splits skewed ones; the session clock is UTC so that
# TIMESTAMP_NTZ <-> date conversions never depend on the host.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, app: str = "gamelake",
              shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Return the active session, or build one with the defaults above.

    On a cluster ``master`` stays None and the launcher's settings win: a default is set
    only where the key is unset. Local runs pass ``local[N]`` and a small
    shuffle-partition count.
    """
    b = SparkSession.builder.appName(app)
    launched = SparkConf()
    if master:
        b = b.master(master)
    conf = {k: v for k, v in DEFAULT_CONF.items() if not launched.contains(k)}
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    A cluster names a shared folder there and we only read it. Only when it is unset
    and all tasks run on this machine (a ``local`` master) do we create a scratch folder
    and register it; a cluster without the setting is an error.
    """
    sc = spark.sparkContext
    d = sc.getConf().get("spark.checkpoint.dir")
    if not d:
        current = sc.getCheckpointDir()
        if current:
            return os.path.dirname(current.rstrip("/"))
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        d = tempfile.mkdtemp(prefix="gamelake-ckpt-")
        sc.setCheckpointDir(d)
    elif sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A path under the shared checkpoint folder (never a machine-local temp dir)."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, *parts)
