"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the jobs are written for. A cluster session should carry the same
# ones, with its own master, memory and number of shuffle partitions.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join even where the aggregate after it then needs a shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # Upload what changed in the state, not whole snapshots.
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}

_local_root: str | None = None


def local_session(cpus: str = "8", memory: str = "8g", **overrides: str) -> SparkSession:
    """A local session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("lodestrata")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
    )
    for key, value in {**SETTINGS, **overrides}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def work_dir(spark: SparkSession, label: str) -> str:
    """A new folder under the cluster's ``spark.checkpoint.dir``.

    Streams keep checkpoints and tables here, so every executor must see it.
    Only a local master may go without the setting.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or _own_local_root(spark)
    return f"{root.rstrip('/')}/lodestrata/{label}-{uuid.uuid4().hex}"


def _own_local_root(spark: SparkSession) -> str:
    global _local_root
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    if _local_root is None:
        _local_root = tempfile.mkdtemp(prefix="lodestrata-")
    return _local_root
