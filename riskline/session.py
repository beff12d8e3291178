"""Session helpers.

The library never creates a cluster session on its own.  ``prepare`` only sets
what correctness depends on (UTC session time zone) and, when the cluster did
not name one, a checkpoint directory for tests.
"""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

_CHECKPOINT_KEY = "spark.checkpoint.dir"


def prepare(spark: SparkSession) -> SparkSession:
    """Make a session safe for the library's time arithmetic."""
    if spark.conf.get("spark.sql.session.timeZone", None) != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder that the cluster names in ``spark.checkpoint.dir``.

    Only a local session without the setting (unit tests) gets a folder of its own; anywhere else a folder of one
    machine would be lost with it, so the missing setting is an error.
    """
    configured = spark.conf.get(_CHECKPOINT_KEY, None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured
    if not re.match(r"local(\[.*\])?$", spark.sparkContext.master):
        raise RuntimeError(f"{_CHECKPOINT_KEY} must name a folder that the driver and all executors share")
    local = tempfile.mkdtemp(prefix="riskline-ckpt-")
    spark.sparkContext.setCheckpointDir(local)
    spark.conf.set(_CHECKPOINT_KEY, local)
    return local


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "riskline") -> SparkSession:
    """Session used by tests, bench and the examples (local mode only)."""
    # Python workers import this package, wherever the session is started from
    here = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    paths = os.environ.get("PYTHONPATH", "").split(os.pathsep)
    os.environ["PYTHONPATH"] = os.pathsep.join([here, *(p for p in paths if p and p != here)])
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("RISKLINE_DRIVER_MEMORY", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.autoBroadcastJoinThreshold", str(32 * 1024 * 1024))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return prepare(spark)


def materialize(df):
    """Cut lineage once a frame feeds several jobs (driver scalars, several sinks).

    Reliable ``checkpoint`` into the shared folder named by ``spark.checkpoint.dir``
    (survives executor loss; never a local checkpoint).  The scored table is the
    system of record in production, so this matches how it would be stored.
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
