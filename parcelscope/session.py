"""Session and scratch-space helpers.

Scratch data (round-trip writes, lineage cuts) always lives under the
cluster's shared checkpoint directory (``spark.checkpoint.dir``). A private
temporary directory is only created when nothing is configured, which is the
case in local tests.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def get_session(master: str | None = None, app: str = "parcelscope",
                shuffle_partitions: int | None = None,
                extra: dict[str, str] | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings every operator assumes.

    On a cluster, leave ``master`` and ``shuffle_partitions`` unset so the
    cluster's own values apply; AQE then coalesces and splits partitions at
    run time.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint directory, setting one only if unset."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set: scratch data and lineage cuts "
                               "need a folder every executor can reach (e.g. on HDFS or S3)")
        # local mode only (tests, benchmarks): one machine, a private folder is shared
        configured = tempfile.mkdtemp(prefix="parcelscope-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint directory."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/parcelscope-scratch/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once below the shared checkpoint directory and reread it.

    Whatever reads the result sees the same rows in the same partitions as
    written, with exchange reuse on or off, and lost executors cost no
    recomputation.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remove_scratch(spark: SparkSession) -> bool:
    """Delete this session's scratch data, once its results are written."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{ensure_checkpoint_dir(spark).rstrip('/')}/parcelscope-scratch")
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
