"""Spark session helpers.

The library never creates a session on its own inside an operator; callers
pass one in.  ``get_session`` is for tests, the bench and command-line use.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "pagewright") -> SparkSession:
    """Build (or reuse) a session configured for this engine.

    AQE is on so shuffle partition counts adapt at run time and skewed join
    partitions are split; the session time zone is UTC so timestamp parsing
    does not depend on the machine running it.
    """
    master = master or os.environ.get("PAGEWRIGHT_MASTER", "local[*]")
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("PAGEWRIGHT_DRIVER_MEMORY", "16g"))
        .config("spark.sql.files.maxPartitionBytes", str(64 * 1024 * 1024))
    )
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster that setting points at shared storage and is left alone.
    Only when it is unset on a local master (tests) is a scratch folder created;
    on a cluster executors could not see one, so that is an error.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if current:
        spark.sparkContext.setCheckpointDir(current)
        return current
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    path = tempfile.mkdtemp(prefix="pagewright-ckpt-")
    spark.conf.set("spark.checkpoint.dir", path)
    spark.sparkContext.setCheckpointDir(path)
    return path
