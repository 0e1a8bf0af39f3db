"""Exact duplicates by sorting contents, with DataFrame operations only.

Rows are range-partitioned by sampled splitters over the first bytes of the text, a
hash of the whole, and a salt from the id; the first bytes bound what the splitters
weigh, the hash parts texts with a common beginning, and the salt spreads the copies
of one text over ``SALTS`` ranges. The external sort that Spark runs below a window
puts equal texts beside each other, where the window tells them apart by comparing
neighbours in full. Each run of equal rows then gives one row, at most ``SALTS`` for a
text, and the same sort over those joins the runs of a text.

A null text is empty. Of equal texts the largest id stays; a null id is smaller than
all others. Repeated rows are repeated in the result, with the same decision.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SALTS = 64
#: Bytes of a text in the splitters.
PREFIX = 48


def _partitioned(df: DataFrame, *salt: str) -> DataFrame:
    return df.repartitionByRange("head", "hash", *salt)


def exact_duplicates(docs: DataFrame, normalise: Column | None = None) -> DataFrame:
    """doc_id, keep_id, group_size, kept and text_sha256 of every row.

    ``normalise`` is the text that is compared, the text itself unless given.
    """
    text = F.coalesce(F.col("text") if normalise is None else normalise, F.lit("")).cast("binary")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("content")).select(
        "doc_id",
        "content",
        F.substring("content", 1, PREFIX).alias("head"),
        F.xxhash64("content").alias("hash"),
        F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(SALTS)).cast("int").alias("salt"),
    )
    keys = ["head", "hash", "salt", "content"]
    # Range partitions of a prefix of the keys are what the window asks for: no second shuffle.
    run = Window.partitionBy(*keys)
    first = Window.partitionBy(*keys).orderBy(F.col("doc_id").desc_nulls_last())
    local = _partitioned(rows, "salt").select(
        "doc_id",
        "head",
        "hash",
        "salt",
        "content",
        F.first("doc_id").over(first).alias("run_id"),
        F.row_number().over(first).alias("place"),
        F.count(F.lit(1)).over(run).alias("n"),
    )
    text_keys = ["head", "hash", "content"]
    whole = Window.partitionBy(*text_keys)
    runs = _partitioned(local.where("place = 1").select("head", "hash", "salt", "content", "run_id", "n"))
    runs = runs.select(
        "hash",
        "salt",
        "run_id",
        F.sha2("content", 256).alias("text_sha256"),
        F.max("run_id").over(whole).alias("keep_id"),
        F.sum("n").over(whole).alias("group_size"),
    )
    # The rows of a run, told by its largest id and the hashes of its text.
    members = local.select("doc_id", "run_id", "hash", "salt", F.sha2("content", 256).alias("sha"))
    match = (
        (members["hash"] == runs["hash"])
        # None of these is null but the id; told so, Spark adds no filter that keeps it from sharing the first shuffle.
        & members["salt"].eqNullSafe(runs["salt"])
        & members["run_id"].eqNullSafe(runs["run_id"])
        & members["sha"].eqNullSafe(runs["text_sha256"])
    )
    return members.join(runs, match).select(
        "doc_id",
        "keep_id",
        "group_size",
        members["doc_id"].eqNullSafe(F.col("keep_id")).alias("kept"),
        "text_sha256",
    )


#: The same result in DuckDB.
ORACLE = """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))
"""
