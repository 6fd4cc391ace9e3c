"""Session settings and shared scratch storage."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def session(name: str = "storyloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators expect. Sizes of clusters and
    memory stay with spark-submit."""
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors reach, as the cluster names it. Only a local
    session that names none (a test) gets a temporary folder."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("name a folder that all executors share in spark.checkpoint.dir")
        named = tempfile.mkdtemp(prefix="storyloom-")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(named)
    return named


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Give costly work on a scan of few splits to all cores. A scan with at least as
    many splits as cores, as any large table has, stays as it is."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, *keys) if df.rdd.getNumPartitions() < cores else df


def durable(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint, so that a lost executor costs a
    re-read instead of a recomputation of all earlier rounds. Each checkpoint gets a
    folder of its own, which ``release`` deletes."""
    base = shared_dir(df.sparkSession)
    folder = f"{base.rstrip('/')}/rounds-{uuid.uuid4().hex}"
    df.sparkSession.sparkContext.setCheckpointDir(folder)
    kept = df.checkpoint()
    kept._checkpoint_folder = folder
    return kept


def release(*frames: DataFrame) -> None:
    """Delete the checkpoints of rounds that a later checkpoint has replaced. Only frames
    that ``durable`` returned and that nothing still to run reads may be given."""
    for df in frames:
        folder = getattr(df, "_checkpoint_folder", None)
        if folder is None:
            continue
        spark = df.sparkSession
        target = spark._jvm.org.apache.hadoop.fs.Path(folder)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
        df._checkpoint_folder = None
