"""Labelled rows to learn from, and tables of the given folder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def crc_mod(column: str, n: int) -> Column:
    """crc32 of an integer as text, modulo n; -1 for null."""
    return F.coalesce(F.crc32(F.col(column).cast("string")) % n, F.lit(-1)).cast("int")


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, rows: int) -> DataFrame:
    """At most ``rows`` labelled documents of each class, by a hash of their id: doc_id, text, label, fold.

    Held-out documents (crc32 modulo 4 is 2) are never taken. A document that is
    labelled more than once counts as 1 if any label does. ``fold`` is the
    remainder, 0, 1 or 3. The sample is the only thing that reaches one place.
    """
    known = (
        labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(F.max(label).alias("label"))
        .withColumn("fold", crc_mod("doc_id", 4))
        .where("fold <> 2")
    )
    order = [F.xxhash64(F.col("doc_id"), F.lit(17)), F.col("doc_id")]
    picked = [known.where(F.col("label") == k).orderBy(*order).limit(rows) for k in (0, 1)]
    return docs.select("doc_id", "text").join(F.broadcast(picked[0].union(picked[1])), "doc_id")
