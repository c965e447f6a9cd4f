"""Session construction and the checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every session of ours wants; a cluster deployment passes its own
# values for the sizing knobs (shuffle partitions, maxPartitionBytes).
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # remove reliable-checkpoint files once their RDD is garbage collected
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "tillroll", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings above.

    ``master`` defaults to ``local[$BENCH_CPUS or 8]``; on a cluster leave the
    master to spark-submit by passing ``master=""``.
    """
    b = SparkSession.builder.appName(app_name)
    if master is None:
        master = f"local[{os.environ.get('BENCH_CPUS', '8')}]"
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, setting one only when none is set.

    On a cluster the folder must be shared storage named by
    ``spark.checkpoint.dir``; we never invent a machine-local one there.  In
    local mode (tests, bench) an unset folder is replaced by a fresh temp dir.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = sc.getConf().get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at shared storage "
            "(HDFS/S3/ABFS) before running operators that cut lineage")
    local_dir = tempfile.mkdtemp(prefix="tillroll-ckpt-")
    sc.setCheckpointDir(local_dir)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path for a written intermediate table, under the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
