"""Session helpers.

Library code never creates a cluster session on its own; callers pass one in.
``ensure_session_defaults`` pins the settings every operator relies on (UTC
session time zone, AQE) on whatever session it is given.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the operators depend on for correct results.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
}

# Settings that only affect planning and the physical plan.
PLAN_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def ensure_session_defaults(spark: SparkSession) -> SparkSession:
    for key, value in {**REQUIRED_CONF, **PLAN_CONF}.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def build_session(
    master: str = "local[*]",
    app_name: str = "candlewick",
    shuffle_partitions: int = 8,
    extra_conf: dict | None = None,
) -> SparkSession:
    """Local session for tests, benches and scripts (UI off, UTC, AQE on)."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("CANDLEWICK_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # a single machine: let AQE keep more, smaller post-shuffle partitions
        # so CPU-heavy parsing after a small shuffle still uses every core
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64KB")
        # this session's own choice, never set on a caller's: on small inputs the
        # wide text-parsing plans spend longer inferring constraints than running
        .config("spark.sql.constraintPropagation.enabled", "false")
    )
    for key, value in {**REQUIRED_CONF, **PLAN_CONF, **(extra_conf or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return ensure_session_defaults(spark)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for stream state and lineage cuts (``spark.checkpoint.dir``).

    There is no fallback: state in a machine's own folder would be lost with it.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    spark.sparkContext.setCheckpointDir(configured)
    return configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path for intermediate files, in the shared folder (``spark.checkpoint.dir``).

    Where that is unset, only a session in local mode gets a folder of this machine.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="candlewick-")
    return f"{shared}/{name}-{uuid.uuid4().hex}"
