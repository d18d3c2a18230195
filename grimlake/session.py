"""Session construction and cluster-shared checkpoint location."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import SparkSession

# Session defaults for the warehouse jobs. AQE re-plans joins from real
# shuffle sizes (broadcast demotion/promotion, partition coalescing, skew
# splits); nothing here pins a physical strategy.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "grimlake", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if master and master.startswith("local"):
        # Local mode runs every executor thread inside the driver JVM.
        conf.setdefault("spark.driver.memory", "16g")
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, installing it on the context.

    On a cluster ``spark.checkpoint.dir`` names a folder that driver and
    executors share, and the job fails without it. Only in local mode, where
    all tasks run in one process, an unset folder is made on this machine.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get(
        "spark.checkpoint.dir", None)
    if not conf_dir:
        if not re.match(r"local(\[|$)", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        conf_dir = "file://" + tempfile.mkdtemp(prefix="grimlake-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir
