"""Session helpers.

Operators never build or configure a session: the caller owns it.  These
helpers exist for tests, the bench and the command line, and for
the one thing operators do need from the session: a shared directory for
materialised intermediates (checkpoints, round-trip copies).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings for a local session.  On a cluster the deployment decides these;
# only AQE (runtime coalescing, skew-join splitting, broadcast conversion
# from real shuffle sizes) matters to the plans in this package.
LOCAL_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app_name: str = "cartwheel", extra: dict | None = None) -> SparkSession:
    """A local[N] session for tests and benchmarks."""
    builder = (SparkSession.builder.master(f"local[{cores}]").appName(app_name)
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", os.environ.get("CARTWHEEL_DRIVER_MEMORY", "8g")))
    for key, value in {**LOCAL_CONF, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint directory, creating a local one only if unset.

    On a cluster ``spark.checkpoint.dir`` names a shared, fault-tolerant
    folder and is used as is.  Only when nothing is configured (a local test
    run) is a fresh temporary folder created and registered.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is not set: a cluster needs a shared, "
                           "fault-tolerant folder for intermediates, not a machine-local one")
    local = tempfile.mkdtemp(prefix="cartwheel-ckpt-")
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir() or local


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint directory."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A :func:`shared_path` that is deleted when the application ends."""
    path = shared_path(spark, name)
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(hadoop)
    return path


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder that this application wrote under the shared directory."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)
