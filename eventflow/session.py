"""Session settings and the shared folder used for state and checkpoints."""

from __future__ import annotations

import tempfile
import time
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def tune(spark: SparkSession) -> SparkSession:
    """Settings the operators rely on: UTC rendering and adaptive execution."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names; a local one only when none is set.

    A cluster must set ``spark.checkpoint.dir`` (or call ``setCheckpointDir``): the
    fallback below is for local masters, where every task sees the same disk.
    """
    root = spark.conf.get(CHECKPOINT_CONF, None)
    if root:
        return root
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder every executor can reach")
    root = tempfile.mkdtemp(prefix="eventflow-")
    spark.sparkContext.setCheckpointDir(root)
    return root


def run_series(spark: SparkSession, checkpoint: str) -> int:
    """Start time (millis) of a stream, kept beside its checkpoint.

    The first start writes it, later ones read it, so names made from it survive a restart
    and differ from those of another checkpoint.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{checkpoint.rstrip('/')}/series")
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        own = spark._jvm.org.apache.hadoop.fs.Path(f"{checkpoint.rstrip('/')}/.series-{uuid.uuid4().hex}")
        out = fs.create(own, False)
        out.writeLong(time.time_ns() // 1_000_000)
        out.close()
        fs.rename(own, path)
    held = fs.open(path)
    try:
        return held.readLong()
    finally:
        held.close()


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared folder, removed when the driver ends."""
    root = f"{checkpoint_root(spark).rstrip('/')}/eventflow-{spark.sparkContext.applicationId}"
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        fs.mkdirs(path)
        fs.deleteOnExit(path)
    return f"{root}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: fixes row placement and survives executor loss."""
    spark = df.sparkSession
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(checkpoint_root(spark))
    return df.checkpoint(eager=True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back: the rows are made once."""
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
