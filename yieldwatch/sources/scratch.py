"""The shared folder for intermediate tables.

A cluster names a folder that every executor can reach in ``spark.checkpoint.dir``. Only
where that setting is absent and the master is local, as in a test, is a folder of our own
used; elsewhere a missing setting is an error.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    local = tempfile.mkdtemp(prefix="yieldwatch-")
    spark.sparkContext.setCheckpointDir(local)
    return local


def clean_up(spark: SparkSession) -> bool:
    """Delete this application's intermediate tables; results that read them are lost."""
    return delete(spark, f"{shared_dir(spark).rstrip('/')}/yieldwatch/{spark.sparkContext.applicationId}")


def delete(spark: SparkSession, path: str) -> bool:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder, in this application's own part of it."""
    application = spark.sparkContext.applicationId
    return f"{shared_dir(spark).rstrip('/')}/yieldwatch/{application}/{name}-{uuid.uuid4().hex}"


def settle(df: DataFrame) -> DataFrame:
    """Compute `df` once into a table in the shared folder.

    Later uses read the table, so they neither repeat the work nor depend on the executors
    that did it, and the planner knows its real size.
    """
    path = scratch_path(df.sparkSession, "settled")
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._settled_at = path
    return out


def discard(df: DataFrame) -> bool:
    """Delete the table that `settle` returned as `df`; nothing may read it any more."""
    return delete(df.sparkSession, df._settled_at)


def release(spark: SparkSession) -> None:
    """Let Spark delete shuffles and cached rows of results that are gone. It does so when the driver's
    memory is collected, which else may be long after the disks are full."""
    spark.sparkContext._jvm.System.gc()
