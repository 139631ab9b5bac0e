"""SparkSession helpers.

The library never creates a session on its own inside an operator; these
helpers are for scripts, tests and the bench.  On a cluster the session is
built by the platform and only ``ensure_checkpoint_dir`` is used: it reads
``spark.checkpoint.dir`` from the session and sets a local one only where
the cluster left it unset (tests, local runs).
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8,
                  app_name: str = "eventlens", extra: dict | None = None) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("EVENTLENS_DRIVER_MEMORY", "8g"))
    )
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint directory (``spark.checkpoint.dir``).

    When it is unset, a temporary folder is created only on a ``local[...]``
    master (tests, laptops); on a cluster a machine-local folder would not be
    shared by the executors, so an error asks for a shared location instead.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir", None)
    if not configured:
        jdir = spark.sparkContext._jsc.sc().getCheckpointDir()
        configured = jdir.get() if jdir.isDefined() else None
    if configured:
        spark.sparkContext.setCheckpointDir(configured)
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a shared folder (staged writes go there)")
    local = tempfile.mkdtemp(prefix="eventlens-ckpt-")
    spark.conf.set("spark.checkpoint.dir", local)
    spark.sparkContext.setCheckpointDir(local)
    return local
