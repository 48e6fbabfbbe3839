"""Session construction and the shared folder used to cut lineage."""

from __future__ import annotations

import os
import re
import uuid

from pyspark.sql import SparkSession

# Settings every plan in the package relies on. ANSI stays on (Spark 4
# default): the operators use try_* functions wherever input may be dirty.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.compression.codec": "snappy",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(
    app_name: str = "jobmart",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Return a session with the package defaults.

    On a cluster leave ``master`` unset (spark-submit provides it) and size
    ``shuffle_partitions`` to the data (roughly input bytes / 128 MB);
    AQE coalesces small partitions at run time.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in SESSION_DEFAULTS.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession, fallback: str = "/tmp/jobmart-checkpoints") -> str:
    """Use the cluster's ``spark.checkpoint.dir``; set ``fallback`` only when unset.

    On a cluster the setting names a shared folder (HDFS/object store) so
    checkpoints and intermediate tables survive executor loss; a
    machine-local fallback is used only in local mode (tests), otherwise an
    unset setting is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        # local-cluster[...] has executors of its own, which a local folder does not reach.
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS/object store)")
        spark.conf.set("spark.checkpoint.dir", fallback)
    directory = configured or fallback
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(directory)
    return directory


_made: list[str] = []


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for one run's outputs; it stays
    until ``drop_shared``, as results may still read it."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    _made.append(f"{base}/jobmart/{name}-{uuid.uuid4().hex[:12]}")
    return _made[-1]


def drop_shared(spark: SparkSession) -> int:
    """Delete the folders that ``shared_dir`` gave out in this process, once no result
    that reads them is needed; returns how many there were."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    found = 0
    while _made:
        path = jvm.org.apache.hadoop.fs.Path(_made.pop())
        found += path.getFileSystem(conf).delete(path, True)
    return found


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")
