"""Session settings the operators rely on, and a local session for tests and the bench."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Every timestamp is UTC; a repeated JSON key keeps its last value.
_REQUIRED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.variant.allowDuplicateKeys": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Set the runtime options that results depend on; everything else stays the cluster's."""
    for key, value in _REQUIRED.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def local_session(name: str, cpus: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A single-machine session for tests and the bench."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def shared_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder for tables and stream checkpoints, under the cluster's shared folder.

    The shared folder is ``spark.checkpoint.dir``.  Only a local-mode session, where the
    driver and the tasks are one process, may fall back to a temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        base = tempfile.mkdtemp(prefix="eventmarts-")
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"
