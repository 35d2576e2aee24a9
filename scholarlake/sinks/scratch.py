"""Folders for intermediate tables, in storage that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder that spark.checkpoint.dir names.

    Where it is unset, a session without a cluster gets a temporary folder, once;
    on a cluster that is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="scholarlake-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def new_folder(spark: SparkSession, prefix: str) -> str:
    """A new name in the shared folder; goes when the session ends, if not before."""
    path = f"{shared_folder(spark)}/{prefix}-{uuid.uuid4().hex}"
    files, hadoop_path = _hadoop(spark, path)
    files.deleteOnExit(hadoop_path)
    return path


def remove(spark: SparkSession, path: str) -> None:
    files, hadoop_path = _hadoop(spark, path)
    files.delete(hadoop_path, True)


def exists(spark: SparkSession, path: str) -> bool:
    files, hadoop_path = _hadoop(spark, path)
    return files.exists(hadoop_path)


def _hadoop(spark: SparkSession, path: str):
    """The one place that reaches for the JVM's file systems."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path
