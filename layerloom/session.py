"""Session helpers: defaults for a local session, runtime options, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import SparkSession

# Options the operators rely on. All of them are runtime SQL options, so `tune` can also apply them to a session
# that somebody else created. Skew-join splitting may add a shuffle below an aggregation on the same key; that is
# the better trade when one key can hold a third of the rows, hence forceOptimizeSkewedJoin.
RUNTIME_OPTIONS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply RUNTIME_OPTIONS to an existing session and return it."""
    for key, value in RUNTIME_OPTIONS.items():
        spark.conf.set(key, value)
    return spark


def local_session(cpus: str | int = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A session for tests and the benchmark; a cluster job brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("layerloom")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    spark = tune(builder.getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it in spark.checkpoint.dir.

    Only a local master without that setting falls back to a temporary folder of this machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    return _local_folder()


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="layerloom-")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder; nothing is created or removed here."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex[:12]}"
