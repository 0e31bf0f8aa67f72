"""Session settings and the shared scratch area."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings the operators rely on (UTC days, runtime re-planning, partition-wise upserts).
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # zone-less parquet timestamps read as UTC instants: no cast between a time filter and the scan
    "spark.sql.parquet.inferTimestampNTZ.enabled": "false",
    # whole texts go to Python in batches: fewer rows keep a batch to some MB on both sides
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
}


def build_session(app: str = "newsmill", master: str | None = None, **conf: str) -> SparkSession:
    """Start (or reuse) a session; on a cluster leave ``master`` unset and let spark-submit decide."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def apply_runtime_conf(spark: SparkSession) -> None:
    """Bring a session somebody else built to the settings in RUNTIME_CONF."""
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: the cluster's ``spark.checkpoint.dir``; where that is unset, the
    application's checkpoint folder, and in local mode a temporary one."""
    ctx = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or ctx.getCheckpointDir()
    if root is None:
        if not ctx.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        root = tempfile.mkdtemp(prefix="newsmill-")
    if ctx.getCheckpointDir() is None:
        ctx.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder.  Nothing is deleted here: empty the folder between jobs."""
    return os.path.join(shared_dir(spark), f"{name}-{uuid.uuid4().hex[:12]}")


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the jobs begun here go when their job ends, not when the driver happens to collect its garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def materialize(df: DataFrame) -> DataFrame:
    """Run the plan once, as a parquet table on shared storage, and continue from that table.

    Used where several branches, or a job that picks block bounds, would otherwise each recompute everything
    upstream.  Later stages read only the columns they need, see real sizes, and a lost executor re-reads files."""
    spark = df.sparkSession
    path = scratch_path(spark, "stage")
    df.write.mode("error").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
