"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def build_session(master: str | None = None, shuffle_partitions: int = 8,
                  app_name: str = "fleetlake", extra: dict | None = None) -> SparkSession:
    """Session with the settings the library assumes.

    On a cluster pass ``master=None`` and let spark-submit decide; size
    ``spark.sql.shuffle.partitions`` to the data (AQE coalesces small
    partitions and splits skewed ones at run time).
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        # streaming state off-heap in RocksDB (bounded JVM memory for large
        # state), committed as changelogs instead of full snapshots
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    }
    if master and master.startswith("local"):
        conf.setdefault("spark.driver.memory", "8g")
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and materialised intermediates.

    Read from ``spark.checkpoint.dir``. Only a local-mode session (tests,
    laptop) gets a fresh scratch folder when the setting is absent; on a
    cluster a missing setting is an error, never a machine-local path.
    """
    d = spark.conf.get(CHECKPOINT_CONF, None)
    if not d:
        master = spark.sparkContext.master
        if not master.startswith("local"):
            raise RuntimeError(
                f"{CHECKPOINT_CONF} is not set; point it at a shared folder "
                "(HDFS/S3/GCS) reachable by every executor")
        d = tempfile.mkdtemp(prefix="fleetlake-ckpt-")
        spark.conf.set(CHECKPOINT_CONF, d)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the checkpoint folder for a written intermediate table."""
    return os.path.join(checkpoint_dir(spark), name)
