"""Equi joins of events with transactions and creations.

No join carries a broadcast hint: Spark broadcasts the transaction side while
its size is under ``spark.sql.autoBroadcastJoinThreshold`` (or, measured after a
shuffle, the adaptive threshold) and falls back to a shuffle join beyond it,
where adaptive execution splits the partitions of a hot hash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stateloom.functions.expressions import normalize_hex, spread


def _same(left: Column, right: str) -> Column:
    """Equal hashes. The number of each leads, so that the sorts of a shuffle join compare numbers."""
    return (spread(left) == spread(right)) & (left == F.col(right))


def join_tx(events: DataFrame, transactions: DataFrame, how: str = "inner") -> DataFrame:
    """Events of the given transactions, both with the numbers of ``transaction_id`` and without words."""
    renamed = transactions.withColumnsRenamed({"tx_1": "successful_1", "tx_2": "successful_2"})
    same = (F.col("tx_1") == F.col("successful_1")) & (F.col("tx_2") == F.col("successful_2"))
    return events.join(renamed, same, how).drop("successful_1", "successful_2")


def join_tx_index(events: DataFrame, tx_index: DataFrame) -> DataFrame:
    """Events of the given transactions, with the transaction index.

    ``tx_index`` must hold each hash once.
    """
    indexed = tx_index.withColumnRenamed("transaction_hash", "successful")
    return events.join(indexed, _same(F.col("transaction_hash"), "successful")).drop("successful")


def semi_tx_success(events: DataFrame, tx_hashes: DataFrame, raw: bool = False) -> DataFrame:
    """Events of the given transactions; repeated hashes do not repeat events.

    ``raw`` events still carry the hash as stored. Comparing it normalised here,
    on a stored column, is what lets Spark move the join below a grouping by it.
    """
    successful = tx_hashes.select(F.col("transaction_hash").alias("successful"))
    stored = F.col("transaction_hash")
    return events.join(successful, _same(normalize_hex(stored) if raw else stored, "successful"), "left_semi")


def left_join_creation(destructs: DataFrame, creations: DataFrame) -> DataFrame:
    """Flag destructs of accounts created in the same transaction."""
    created = (
        creations.select("address", "transaction_hash")
        .distinct()
        .withColumn("created", F.lit(True))
    )
    return destructs.join(created, ["address", "transaction_hash"], "left").select(
        *destructs.columns, F.col("created").isNotNull().alias("is_same_tx")
    )
