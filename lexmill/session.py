"""Session settings and the shared folder for written intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(app: str = "lexmill", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators rely on.

    Adaptive execution sizes the shuffle partitions from real data volumes and
    splits skewed join partitions, so no partition count is set here.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for name, value in conf.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Where none is named, a temporary folder is used under a local master (tests); on a
    cluster that is an error, as executors would each write to their own disk.
    The folder is also made known to ``DataFrame.checkpoint``.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if not root:
        root = context.getCheckpointDir()
        if not root:
            if not context.master.split("[")[0] == "local":
                raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
            root = tempfile.mkdtemp(prefix="lexmill-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder; nothing is created or reused."""
    return f"{checkpoint_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df, name: str = "table", compression: str | None = None):
    """Write a table to the shared folder and read it back: cuts the lineage, and lets
    several readers share one computation that outlives lost executors. ``compression`` names
    another codec than the session's."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)
