"""Session helpers: defaults for tests/bench and the checkpoint location."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Session defaults that matter for the operators here.  On a cluster these are
# expected in spark-defaults; ``get_spark`` only fills what is unset.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

BROADCAST_BYTES_KEY = "fleetpulse.broadcast.maxBytes"
BUCKET_SECONDS_KEY = "fleetpulse.window.bucketSeconds"


def get_spark(master: str | None = None, app: str = "fleetpulse",
              shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Return the active session as it is, or build one with the defaults above."""
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    return builder.config(map=conf).getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Make sure ``DataFrame.checkpoint`` has a reliable directory.

    The directory named by ``spark.checkpoint.dir`` (a shared file system on a
    cluster) wins.  Only a local-mode session with nothing configured gets a
    fresh directory under the system temp folder, as in tests.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get(
        "spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at a shared folder of the cluster")
    local = tempfile.mkdtemp(prefix="fleetpulse-ckpt-")
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir()


def materialize(df, label: str = "stage"):
    """Write ``df`` once as Parquet under the checkpoint directory and read it back.

    Cuts lineage like ``checkpoint()`` (a lost executor recomputes from the
    files, not from the sources) but runs the plan exactly once, where an
    eager RDD checkpoint computes it a second time to write it.
    """
    spark = df.sparkSession
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/fleetpulse-{label}-{uuid.uuid4().hex}"
    df.write.mode("errorifexists").parquet(path)
    # Stages last as long as the application that may still read them.
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(hadoop)
    return spark.read.parquet(path)


def temporary_folder(spark, label: str) -> str:
    """A new folder under the checkpoint directory, removed when the application ends."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/fleetpulse-{label}-{uuid.uuid4().hex}"
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(hadoop)
    fs.deleteOnExit(hadoop)
    return path


def conf_int(spark: SparkSession, key: str, default: int) -> int:
    value = spark.conf.get(key, None)
    return int(value) if value not in (None, "") else default


def shuffle_partitions(spark: SparkSession) -> int:
    return conf_int(spark, "spark.sql.shuffle.partitions", 200)
