"""Session helpers: a tuned local session for tests/bench and checkpoint dir."""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

_DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # coalesce shuffle output by size (advisory partition bytes), not by
    # core count: small stages become one task, large ones stay split
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # the driver keeps each execution's plan text; these plans are large
    "spark.sql.ui.retainedExecutions": "50",
}


def get_spark(master: str | None = None, app: str = "framewatch",
              shuffle_partitions: int | None = None,
              extra: dict[str, str] | None = None) -> SparkSession:
    """Build (or reuse) a session with AQE on and the UI off."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(_DEFAULTS)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names.

    On a cluster ``spark.checkpoint.dir`` (a static setting) points at shared
    storage and is used as is.  Only in local mode, when nothing is configured
    (unit tests, a laptop), a scratch folder is created and registered with
    ``setCheckpointDir`` (the setting itself cannot change at runtime); on a
    cluster a missing setting is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    if not re.match(r"local(\[|$)", sc.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="framewatch-ckpt-"))
    return sc.getCheckpointDir()


def share_package(spark: SparkSession | None = None) -> None:
    """Let Python workers import this package from where the driver has it.  On a
    cluster it is installed on the executors, and the added path does no harm."""
    spark = spark or SparkSession.active()
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (root, env.get("PYTHONPATH")) if x)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A folder under the shared checkpoint folder for written intermediate tables."""
    return os.path.join(ensure_checkpoint_dir(spark).rstrip("/"), "framewatch", name)
