"""Session defaults and the shared scratch location.

Everything that must survive executor loss (checkpoints, staged tables,
versioned tables written by the registered queries) goes under the folder
the cluster names in ``spark.checkpoint.dir``. A folder of our own is only
chosen when the session has none (local tests).
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

from riskflow.errors import ConfigError

# Settings every riskflow job relies on. Event times are UTC wall-clock
# values; pinning the session zone keeps NTZ <-> TIMESTAMP casts exact.
SESSION_DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(
    master: str = "local[*]",
    app_name: str = "riskflow",
    shuffle_partitions: int = 8,
    extra: dict | None = None,
) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(SESSION_DEFAULTS)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's reliable checkpoint folder, setting one only if unset."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        # Local runs and tests only: on a cluster each executor would write to its own disk.
        if not sc.master.startswith("local"):
            raise ConfigError("spark.checkpoint.dir must name a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="riskflow-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint location for one run's tables."""
    root = ensure_checkpoint_dir(spark)
    return f"{root.rstrip('/')}/riskflow-work/{name}-{uuid.uuid4().hex[:12]}"


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme for local filesystem helpers."""
    if path.startswith("file://"):
        return path[len("file://"):]
    if path.startswith("file:"):
        return path[len("file:"):]
    return path


def default_parallelism(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def materialize(df, name: str = "stage", partition_by=None):
    """Cut lineage by writing ``df`` as a Parquet table under the shared checkpoint folder.

    One job, columnar files, and a plain scan afterwards; a lost executor
    re-reads files instead of recomputing the plan. (A reliable RDD
    checkpoint would run the plan twice - count, then write - and store
    Java-serialized rows.) ``partition_by``: write partitioned, so later
    filters on those columns read only their folders.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*([partition_by] if isinstance(partition_by, str) else partition_by))
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
