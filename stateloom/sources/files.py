"""Directory operations through the file system Spark itself uses."""

from __future__ import annotations

import tempfile
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import SparkSession

# What a failed analysis or job may raise.
SPARK_ERRORS = (PySparkException, Py4JJavaError)


def _open(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _open(spark, path)
    return fs.exists(target)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names directly under a directory, sorted; empty when it does not exist."""
    fs, target = _open(spark, path)
    if not fs.exists(target):
        return []
    return sorted(entry.getPath().getName() for entry in fs.listStatus(target))


def delete(spark: SparkSession, path: str) -> None:
    fs, target = _open(spark, path)
    fs.delete(target, True)


def shared_dir(spark: SparkSession) -> str:
    """A fresh folder that every executor can reach.

    Its root is the checkpoint folder named by the session. Without one, a local
    session gets a temporary folder and a cluster session is refused, since a
    folder of one machine is lost with that machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        root = tempfile.mkdtemp(prefix="stateloom-")
    return f"{root.rstrip('/')}/stateloom-{uuid.uuid4().hex}"
