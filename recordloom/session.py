"""Session settings the operators look at."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``.

    Only a session whose tasks run in this one process may leave the setting unset. A cluster
    must name the folder, because a machine-local path would be lost with its executor.
    """
    folder = spark.conf.get(CHECKPOINT_KEY, None) or spark.sparkContext.getConf().get(CHECKPOINT_KEY)
    if folder:
        return folder.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local") or "cluster" in master:
        raise ValueError(f"set {CHECKPOINT_KEY} to a folder shared by all executors")
    return f"{tempfile.gettempdir()}/recordloom"


def fresh_folder(spark: SparkSession, purpose: str) -> str:
    """A new, unused path under the shared folder, removed when the session ends."""
    folder = f"{shared_folder(spark)}/{purpose}-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)
    return folder


def written(df, purpose: str):
    """Cut the lineage of ``df`` by writing it to the shared folder and reading it back.

    Unlike cached blocks the files outlive the executors that wrote them.
    """
    path = fresh_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
