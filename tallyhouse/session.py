"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the library relies on. Cluster sizing (executors, memory, shuffle
# partitions) is left to the deployment.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def local_session(cores: str | int = "*", app: str = "tallyhouse") -> SparkSession:
    """Single-machine session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", "8")
        # Call-site capture costs a round trip per column expression.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for name, value in REQUIRED_CONF.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the result-relevant runtime settings to a session made elsewhere."""
    for name in ("spark.sql.session.timeZone", "spark.sql.ansi.enabled"):
        spark.conf.set(name, REQUIRED_CONF[name])
    return spark


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for written intermediates, as the cluster names it.

    Only a session without ``spark.checkpoint.dir`` that runs on one machine
    gets a local folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    root = tempfile.mkdtemp(prefix="tallyhouse-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    return os.path.join(scratch_root(spark), f"{label}-{uuid.uuid4().hex[:12]}")
