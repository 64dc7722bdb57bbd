"""Session set-up and the shared scratch folder.

Every job here is plain DataFrame / SQL work, so the session only needs the
settings that make Catalyst and AQE do the right thing at scale:

* AQE on, with runtime coalescing and skew-join splitting, so a hot token or a
  hot story key is split across tasks instead of landing in one.
* Runtime broadcast only behind AQE's size check of the *materialized* side
  (``spark.sql.adaptive.autoBroadcastJoinThreshold``); the static threshold
  keeps Spark's own statistics-based check.
* UTC session time zone, so nothing that touches timestamps depends on the
  machine running the driver.
"""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64MB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64MB",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.files.maxPartitionBytes": "128MB",
    "spark.ui.enabled": "false",
}


def build_session(master: str | None = None, app_name: str = "sift",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the settings above.

    On a cluster, leave ``master`` unset so spark-submit decides; locally pass
    ``local[N]``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_CREATED: dict[str, list[str]] = {}  # scratch paths by application


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder for staged tables and checkpoints.

    Read from ``spark.checkpoint.dir`` (the cluster names it). Where it is
    unset, a folder of our own is made on a local master only, and removed
    when the process ends; on a cluster each executor would write to its own
    disk, so that is an error.
    """
    sc = spark.sparkContext
    configured = (spark.conf.get("spark.checkpoint.dir", None)
                  or sc.getConf().get("spark.checkpoint.dir", None))
    if configured:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(configured)
        return configured.rstrip("/")
    current = sc.getCheckpointDir()
    if current:
        # getCheckpointDir() is a per-application subfolder; use its parent.
        return os.path.dirname(current.rstrip("/"))
    if sc.master != "local" and not sc.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    local = tempfile.mkdtemp(prefix="sift-scratch-")
    atexit.register(shutil.rmtree, local, ignore_errors=True)
    sc.setCheckpointDir(local)
    return local


def new_scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never-reused path under the scratch folder."""
    path = f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    _CREATED.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def file_system(spark: SparkSession, path: str):
    """(Hadoop file system, Hadoop path): HDFS, object store or local."""
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hpath


def delete_path(spark: SparkSession, path: str) -> None:
    fs, hpath = file_system(spark, path)
    fs.delete(hpath, True)


def release_scratch(spark: SparkSession) -> None:
    """Delete every scratch path this application has made. Frames that still
    read one of them must have been written elsewhere before."""
    for path in _CREATED.pop(spark.sparkContext.applicationId, []):
        delete_path(spark, path)


def partitions_for(spark: SparkSession, path: str, target_bytes: int = 128 << 20) -> int:
    """Partitions of about ``target_bytes`` for the files under ``path``, at
    least one per core up to one per MB: grows with the data, not with a
    setting."""
    fs, hpath = file_system(spark, path)
    size = fs.getContentSummary(hpath).getLength()
    cores = spark.sparkContext.defaultParallelism
    return max(1, -(-size // target_bytes), min(cores, -(-size // (1 << 20))))


def spread(scan, key: str):
    """Hash-spread a file scan over the cluster's cores by its unique ``key``
    when it has fewer splits, before per-row heavy work (text cleaning).

    Only for the scan itself, before any join: its splits are known without
    running anything. A large input has far more splits than cores and is
    returned unchanged; a small one (one row group) would otherwise clean all
    its text in one task.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    if scan.rdd.getNumPartitions() >= cores:
        return scan
    return scan.repartition(cores, key)
