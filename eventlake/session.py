"""Local session for tests, tools and the bench.  On a cluster the session
comes from the platform; nothing here is needed there."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("eventlake")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("EVENTLAKE_DRIVER_MEMORY", "8g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The cluster names a shared folder in spark.checkpoint.dir, or the application
    has set one on the context; where there is neither, a scratch folder is chosen under
    a local master (tests), and a cluster's job is refused."""
    current = spark.conf.get("spark.checkpoint.dir", None)
    jsc = spark.sparkContext._jsc.sc()
    if not current and jsc.getCheckpointDir().isDefined():
        return jsc.getCheckpointDir().get()
    if current:
        if not jsc.getCheckpointDir().isDefined():
            spark.sparkContext.setCheckpointDir(current)
        return current
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    path = tempfile.mkdtemp(prefix="eventlake-ckpt-", dir="/tmp")
    spark.conf.set("spark.checkpoint.dir", path)
    spark.sparkContext.setCheckpointDir(path)
    return path


def shared_folder(spark: SparkSession, tag: str) -> str:
    """A new folder under spark.checkpoint.dir, which driver and executors share."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{tag}-{uuid.uuid4().hex}"
