"""SparkSession helpers: one place for the session settings the library needs."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

BASE_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # delete a checkpoint's files once nothing refers to it any more
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "docsynth", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the library's defaults.

    On a cluster, pass ``master=None`` and let spark-submit decide; the local
    default is only for tests and benches.
    """
    builder = SparkSession.builder.appName(app_name)
    if master is None and not _master_configured():
        master = "local[*]"
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _master_configured() -> bool:
    """True under spark-submit (or an active session), where the master is set."""
    if SparkSession.getActiveSession() is not None or os.environ.get("SPARK_MASTER"):
        return True
    if os.environ.get("PYSPARK_GATEWAY_PORT"):
        from pyspark import SparkConf
        return SparkConf().contains("spark.master")
    return False


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Make ``df.checkpoint()`` usable and return the directory.

    The cluster names a shared folder in ``spark.checkpoint.dir``; that value is
    used as is. Only a local-mode session without the setting (tests, benches)
    gets a scratch folder of its own; a cluster session without it is an error,
    because a machine-local folder would not survive the loss of an executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder (e.g. on HDFS/S3) for this cluster")
    local = tempfile.mkdtemp(prefix="docsynth-ckpt-")
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir()
