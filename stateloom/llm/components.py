"""Connected components of a table of links, in rounds of joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stateloom.llm.storage import stored


def _stars(links: DataFrame) -> DataFrame:
    """One large and one small star step: every node's neighbours move to its smallest neighbour."""
    both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    large = both.where("v > u").join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    large = large.distinct()
    least = large.groupBy("u").agg(F.min("v").alias("m"))
    down = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return down.union(least.select("u", F.col("m").alias("v"))).distinct()


def components(links: DataFrame, folder: str, name: str = "links") -> DataFrame:
    """``node`` and ``component`` (its smallest node) of every node that is not the smallest of its own.

    ``links`` has two long columns, u and v. Each round is written to the shared
    folder; a hub is combined on the map side in the aggregates, and its rows are
    split by adaptive execution in the joins. It ends when the links are stars: every
    larger node has one link, and none of the smaller ones is a larger one elsewhere.
    """
    pairs = links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    now, k = stored(pairs, folder, f"{name}-0"), 0
    while True:
        single = now.groupBy("u").agg(F.count("*").alias("n")).where("n > 1").limit(1).isEmpty()
        if single and now.join(now.select(F.col("u").alias("v")), "v", "left_semi").isEmpty():
            return now.select(F.col("u").alias("node"), F.col("v").alias("component"))
        k += 1
        now = stored(_stars(now), folder, f"{name}-{k}")
