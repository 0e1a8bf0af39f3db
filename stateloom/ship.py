"""Sending this package to Python workers that do not have it."""

from __future__ import annotations

import os
import shutil
import tempfile

from pyspark.sql import SparkSession

_sent: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Let the workers of this session import ``stateloom``; the driver serves one archive of it."""
    application = spark.sparkContext.applicationId
    if application in _sent:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    archive = shutil.make_archive(os.path.join(tempfile.mkdtemp(), "stateloom"), "zip", root, "stateloom")
    spark.sparkContext.addPyFile(archive)
    _sent.add(application)
