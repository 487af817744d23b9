"""SparkSession construction and shared-storage helpers."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

# Defaults a cluster job would set in spark-defaults; local tests reuse them.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


LOCAL_DRIVER_MEMORY = "8g"


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "cinelens", extra: dict | None = None) -> SparkSession:
    """Return (or create) a session with the library's defaults.

    ``master`` and ``shuffle_partitions`` are only applied when given, so a
    cluster submission keeps whatever the launcher configured.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
        if master.startswith("local"):
            # local mode runs every task inside the driver JVM
            builder = builder.config("spark.driver.memory", LOCAL_DRIVER_MEMORY)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the setting must name shared storage; without it this fails.
    Only a local master (all tasks on this machine) gets a private folder.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        path = tempfile.mkdtemp(prefix="cinelens-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    spark.sparkContext.setCheckpointDir(path)
    return path


def checkpointed(df: DataFrame) -> DataFrame:
    """``df.checkpoint()`` into the shared folder: read many times, computed once, no lineage."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder for written stages."""
    return os.path.join(checkpoint_dir(spark), name)
