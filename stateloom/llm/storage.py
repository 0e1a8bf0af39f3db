"""Intermediate tables in the shared folder of the session."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stateloom.sources.files import delete, shared_dir


def stored(df: DataFrame, path: str | None = None, name: str = "table") -> DataFrame:
    """The same rows from Parquet in the shared folder, without the lineage."""
    spark: SparkSession = df.sparkSession
    target = f"{path or shared_dir(spark)}/{name}"
    df.write.parquet(target)
    return spark.read.schema(df.schema).parquet(target)


def dropped(spark: SparkSession, path: str, name: str) -> None:
    """Remove a table whose successor is stored."""
    delete(spark, f"{path}/{name}")
