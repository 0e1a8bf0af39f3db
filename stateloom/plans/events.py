"""Building blocks of the table plans: normalised events and transactions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stateloom.functions.expressions import is_destruct, moved_nothing, normalize_hex, read_position, transaction_id
from stateloom.operators.blocks import fork_window
from stateloom.operators.dedup import latest_per_key
from stateloom.operators.grouping import per_key
from stateloom.operators.joins import semi_tx_success
from stateloom.operators.unions import union_all
from stateloom.schemas import Forks
from stateloom.sources.inputs import Inputs

Block = int | None


def _hash():
    return normalize_hex("transaction_hash").alias("transaction_hash")


def filter_tx_success(inputs: Inputs, start: Block, end: Block) -> DataFrame:
    """Hash and index of the successful transactions of a range."""
    rows = inputs.scan("transaction", start, end).withColumn("transaction_hash", _hash())
    version = inputs.versions.get("transaction")
    if version:
        # The second key follows from the first; see tx_index.
        rows = latest_per_key(
            rows.withColumn("spread", F.xxhash64("transaction_hash")),
            ["transaction_hash", "spread"],
            version,
            ["success", "transaction_index"],
        )
    return rows.where("success").select("transaction_hash", "transaction_index")


def tx_hashes(inputs: Inputs, start: Block, end: Block) -> DataFrame:
    """Hashes of successful transactions, for a semi join."""
    return filter_tx_success(inputs, start, end).select("transaction_hash")


def tx_index(inputs: Inputs, start: Block, end: Block) -> DataFrame:
    """Index per hash, each hash once, so that an inner join never repeats an event.

    The number that leads the hash in this grouping keeps its partitioning from being
    taken over by a shuffle join: only a join side that is shuffled for the join can be
    cut up when one hash has most of the events.
    """
    return per_key(
        filter_tx_success(inputs, start, end),
        ["transaction_hash"],
        F.max("transaction_index").alias("transaction_index"),
    )


def tx_ids(inputs: Inputs, start: Block, end: Block) -> DataFrame:
    """The successful transactions by their numbers, for a semi join."""
    return filter_tx_success(inputs, start, end).select(*transaction_id())


def tx_ids_once(inputs: Inputs, start: Block, end: Block) -> DataFrame:
    """``tx_ids`` without repeats, for an inner join, which Spark does not take apart over a union as it does a semi join."""
    return per_key(tx_ids(inputs, start, end), ["tx_1", "tx_2"])


def tx_id_index(inputs: Inputs, start: Block, end: Block) -> DataFrame:
    """``tx_index`` by numbers in place of hashes."""
    found = filter_tx_success(inputs, start, end).select(*transaction_id(), "transaction_index")
    return per_key(found, ["tx_1", "tx_2"], F.max("transaction_index").alias("transaction_index"))


def address_events(
    inputs: Inputs, name: str, start: Block, end: Block, address: str = "address", merged: bool = False
) -> DataFrame:
    """Address, block and transaction of one access log.

    ``merged`` drops repeated copies of a row first. Plans that only ask for
    distinct transactions or the first or last block leave that shuffle out, but
    for tables with a version whose key does not hold all three columns: there an
    outdated copy may name another block.
    """
    columns = (address, "block_number", "transaction_hash")
    pick = inputs.latest if merged else inputs.current
    rows = pick(name, start, end, *columns)
    return rows.select(normalize_hex(address).alias("address"), "block_number", _hash())


def union_diffs(inputs: Inputs, start: Block, end: Block, merged: bool = False) -> DataFrame:
    """Everything that changed an account."""
    return union_all(
        address_events(inputs, "balance_diffs", start, end, merged=merged),
        address_events(inputs, "storage_diffs", start, end, merged=merged),
        address_events(inputs, "nonce_diffs", start, end, merged=merged),
        address_events(inputs, "contracts", start, end, "contract_address", merged),
    )


def union_reads(inputs: Inputs, start: Block, end: Block, merged: bool = False) -> DataFrame:
    """Everything that read an account."""
    return union_all(
        address_events(inputs, "balance_reads", start, end, merged=merged),
        address_events(inputs, "nonce_reads", start, end, merged=merged),
        address_events(inputs, "storage_reads", start, end, "contract_address", merged),
    )


def union_accesses(inputs: Inputs, start: Block, end: Block, merged: bool = False) -> DataFrame:
    """Everything that touched an account."""
    return union_all(
        union_diffs(inputs, start, end, merged), union_reads(inputs, start, end, merged)
    )


def slot_writes(inputs: Inputs, start: Block, end: Block) -> DataFrame:
    """Storage writes in the common shape of slot accesses."""
    return inputs.current(
        "storage_diffs", start, end, "address", "slot", "block_number", "to_value", "transaction_hash"
    ).select(
        normalize_hex("address").alias("address"),
        F.col("slot").alias("slot_key"),
        "block_number",
        F.col("to_value").alias("value"),
        _hash(),
    )


def slot_reads(inputs: Inputs, start: Block, end: Block) -> DataFrame:
    """Storage reads in the common shape of slot accesses."""
    return inputs.current(
        "storage_reads", start, end, "contract_address", "slot", "block_number", "value", "transaction_hash"
    ).select(
        normalize_hex("contract_address").alias("address"),
        F.col("slot").alias("slot_key"),
        "block_number",
        "value",
        _hash(),
    )


def union_storage_accesses(inputs: Inputs, start: Block, end: Block) -> DataFrame:
    return union_all(slot_writes(inputs, start, end), slot_reads(inputs, start, end))


def successful_storage_accesses(inputs: Inputs, start: Block, end: Block) -> DataFrame:
    """Slot accesses of successful transactions.

    Where the key of a log holds the hash, all copies of a row are of one transaction: the
    others leave before copies are merged, which then sorts fewer rows.
    """
    hashes = tx_hashes(inputs, start, end)

    def kept(name: str, accesses) -> DataFrame:
        if name in inputs.versions and "transaction_hash" in inputs.keys[name]:
            rows = semi_tx_success(inputs.scan(name, start, end), hashes, raw=True)
            return accesses(inputs.with_tables({name: rows}), start, end)
        return semi_tx_success(accesses(inputs, start, end), hashes)

    return union_all(kept("storage_diffs", slot_writes), kept("storage_reads", slot_reads))


def positioned_writes(inputs: Inputs, start: Block, end: Block) -> DataFrame:
    """Storage writes with their position in the block.

    ``recency`` orders the copies of one write (0 without a version), so the
    position order can pick the newest copy without a merge of its own.
    """
    version = inputs.versions.get("storage_diffs")
    return inputs.scan("storage_diffs", start, end).select(
        normalize_hex("address").alias("address"),
        F.col("slot").alias("slot_key"),
        "block_number",
        "transaction_index",
        "internal_index",
        F.col("to_value").alias("value"),
        (F.col(version) if version else F.lit(0)).cast("long").alias("recency"),
    )


def positioned_reads(reads: DataFrame, first: bool) -> DataFrame:
    """Storage reads with the position that lets a write of the same block win."""
    return reads.select(
        "address",
        "slot_key",
        "block_number",
        read_position(first).alias("transaction_index"),
        read_position(first).alias("internal_index"),
        "value",
        F.lit(0).cast("long").alias("recency"),
    )


def destructs(inputs: Inputs, start: Block, end: Block, account: str = "action_from") -> DataFrame:
    """Destruct traces, seen from the account in the given column."""
    return (
        inputs.scan("traces", start, end)
        .where(is_destruct())
        .select(normalize_hex(account).alias("address"), "block_number", _hash())
    )


def emptied_beneficiaries(inputs: Inputs, start: Block, end: Block) -> DataFrame:
    """Accounts named by a destruct that moved nothing to them."""
    return (
        inputs.scan("traces", start, end)
        .where(is_destruct() & moved_nothing())
        .select(normalize_hex("action_to").alias("address"), "block_number", _hash())
    )


def union_destructs(inputs: Inputs, start: Block, end: Block, forks: Forks) -> DataFrame:
    """Destructs under the early rules; the second scan covers early blocks only."""
    removed = destructs(inputs, start, end)
    early = fork_window(start, end, before=forks.state_clearing)
    if early is None:
        return removed
    return union_all(removed, emptied_beneficiaries(inputs, *early))


def creations(inputs: Inputs, start: Block, end: Block) -> DataFrame:
    return address_events(inputs, "contracts", start, end, "contract_address").select(
        "address", "transaction_hash"
    )
