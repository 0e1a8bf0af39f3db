"""The derived tables.

Every function takes inputs, an inclusive block range (None leaves an end open)
and the fork blocks, and returns a lazy DataFrame. No function runs a job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stateloom import schemas
from stateloom.functions import aggregates as agg
from stateloom.functions import expressions as ex
from stateloom.operators.blocks import fork_window
from stateloom.operators.grouping import per_key
from stateloom.operators.joins import join_tx, join_tx_index, left_join_creation, semi_tx_success
from stateloom.operators.unions import union_all
from stateloom.plans import events as ev
from stateloom.plans.events import Block
from stateloom.schemas import MAINNET, Forks
from stateloom.sources.inputs import Inputs


def transactions_once(events: DataFrame) -> DataFrame:
    """Each transaction of an address and block once: counting these rows equals a distinct count."""
    return per_key(events, ["address", "block_number", "transaction_hash"])


def _identified(events: DataFrame) -> DataFrame:
    """Events by the numbers of their transactions, which lead: a sort by them settles at the first."""
    return events.select(*ex.transaction_id(), "address", "block_number")


def _transactions_per_block(events: DataFrame, tx_id_index: DataFrame) -> DataFrame:
    """Distinct transactions and the last index per address and block.

    A transaction is 128 bits here and not a word of text: rows that are nearly all
    different fill the memory of an aggregate, and half of it is spared. Events travel
    twice: to their transactions, and what is left of them to their address and block,
    where repeats are dropped and the rest is counted without another shuffle.
    """
    return (
        join_tx(_identified(events), tx_id_index)
        .repartition("block_number", "address")
        .distinct()
        .groupBy("block_number", "address")
        .agg(
            F.count(F.lit(1)).alias("tx_count"),
            F.max("transaction_index").alias("last_tx_index"),
        )
        .select(*schemas.ADDRESS_DIFFS.fieldNames())
    )


def address_diffs(inputs: Inputs, start: Block = None, end: Block = None, forks: Forks = MAINNET) -> DataFrame:
    """Transactions that changed an address, per block."""
    return _transactions_per_block(
        ev.union_diffs(inputs, start, end), ev.tx_id_index(inputs, start, end)
    )


def address_reads(inputs: Inputs, start: Block = None, end: Block = None, forks: Forks = MAINNET) -> DataFrame:
    """Transactions that read an address, per block."""
    return _transactions_per_block(
        ev.union_reads(inputs, start, end), ev.tx_id_index(inputs, start, end)
    )


def successful_accesses(inputs: Inputs, start: Block = None, end: Block = None) -> DataFrame:
    """Address and block of every access by a successful transaction, in any number of copies.

    Events travel to their transactions as they are. The first and the last blocks of one
    range have that shuffle in common, which Spark then runs once for both.
    """
    events = _identified(ev.union_accesses(inputs, start, end))
    return join_tx(events, ev.tx_ids_once(inputs, start, end)).select("address", "block_number")


def first_blocks(accesses: DataFrame) -> DataFrame:
    """The first block of every address; an address leaves every task as one row."""
    found = per_key(accesses, ["address"], F.min("block_number").alias("block_number"))
    return found.withColumn("version", ex.inverse_version())


def last_blocks(accesses: DataFrame) -> DataFrame:
    """The last block of every address; an address leaves every task as one row."""
    found = per_key(accesses, ["address"], F.max("block_number").alias("block_number"))
    return found.withColumn("is_deleted", F.lit(False))


def address_first_access(
    inputs: Inputs, start: Block = None, end: Block = None, forks: Forks = MAINNET
) -> DataFrame:
    """First block in which a successful transaction touched an address."""
    return first_blocks(successful_accesses(inputs, start, end))


def address_last_access(
    inputs: Inputs, start: Block = None, end: Block = None, forks: Forks = MAINNET
) -> DataFrame:
    """Last block in which a successful transaction touched an address."""
    return last_blocks(successful_accesses(inputs, start, end))


def _positioned_accesses(inputs: Inputs, start: Block, end: Block, first: bool) -> DataFrame:
    """Writes of all transactions and reads of successful ones, in block order."""
    reads = semi_tx_success(ev.slot_reads(inputs, start, end), ev.tx_hashes(inputs, start, end))
    return union_all(
        ev.positioned_writes(inputs, start, end), ev.positioned_reads(reads, first)
    )


_SLOT = ("address", "slot_key")
_POSITION = ("block_number", "transaction_index", "internal_index")


def slot_first_access_ordered(
    inputs: Inputs, start: Block = None, end: Block = None, forks: Forks = MAINNET
) -> DataFrame:
    """First access of a slot in execution order; a write beats a read of its block."""
    newest_first = (-F.col("recency")).alias("age")
    accesses = _positioned_accesses(inputs, start, end, first=True)
    return (
        per_key(accesses, _SLOT, agg.earliest(*_POSITION, newest_first, "value").alias("at"))
        .select("address", "slot_key", "at.block_number", "at.value")
        .withColumn("version", ex.inverse_version())
    )


def slot_last_access_ordered(
    inputs: Inputs, start: Block = None, end: Block = None, forks: Forks = MAINNET
) -> DataFrame:
    """Last access of a slot in execution order; a write beats a read of its block."""
    accesses = _positioned_accesses(inputs, start, end, first=False)
    return (
        per_key(accesses, _SLOT, agg.latest(*_POSITION, "recency", "value").alias("at"))
        .select("address", "slot_key", "at.block_number", "at.value")
    )


def slot_first_access_success(
    inputs: Inputs, start: Block = None, end: Block = None, forks: Forks = MAINNET
) -> DataFrame:
    """First access of a slot by a successful transaction, in block order."""
    accesses = ev.successful_storage_accesses(inputs, start, end)
    return (
        per_key(accesses, _SLOT, agg.earliest("block_number", "value").alias("at"))
        .select("address", "slot_key", "at.block_number", "at.value")
        .withColumn("version", ex.inverse_version())
    )


def slot_last_access_success(
    inputs: Inputs, start: Block = None, end: Block = None, forks: Forks = MAINNET
) -> DataFrame:
    """Last access of a slot by a successful transaction, in block order."""
    accesses = ev.successful_storage_accesses(inputs, start, end)
    return (
        per_key(accesses, _SLOT, agg.latest("block_number", "value").alias("at"))
        .select("address", "slot_key", "at.block_number", "at.value")
    )


def slot_changes(inputs: Inputs, start: Block = None, end: Block = None) -> DataFrame:
    """Storage writes of successful transactions, each once, with what they did.

    The newest copy of a write decides. Only the newest version of each outcome
    travels through the merge, not the two words of text, and plain maxima of
    numbers keep it a hash aggregate. Nor do the words of its key travel, but for
    the address: 128 bits stand for the key and 128 for the transaction, since the
    merge holds nearly every row apart. The semi join comes after the merge: Spark
    moves it below exactly when the transactions are small enough to broadcast.
    """
    return _slot_changes(inputs, start, end, "address", "block_number")


def _slot_changes(inputs: Inputs, start: Block, end: Block, *columns: str) -> DataFrame:
    keys = inputs.keys["storage_diffs"]
    version = inputs.versions.get("storage_diffs")
    first, second = ex.digest(*keys)
    copies = inputs.scan("storage_diffs", start, end).select(
        first.alias(f"{keys[0]}_digest_1"),
        second.alias(f"{keys[0]}_digest_2"),
        *ex.transaction_id(),
        *(ex.normalize_hex(c).alias(c) if c == "address" else F.col(c) for c in columns),
        ex.slot_transition().alias("transition"),
        (F.col(version) if version else F.lit(0)).alias("copy"),
    )
    writes = copies.groupBy(*(c for c in copies.columns if c not in ("transition", "copy"))).agg(
        F.max("copy").alias("newest"),
        F.max(F.when(F.col("transition") == 1, F.col("copy"))).alias("newest_set"),
        F.max(F.when(F.col("transition") == -1, F.col("copy"))).alias("newest_cleared"),
    )
    return join_tx(writes, ev.tx_ids(inputs, start, end), "left_semi").select(
        *columns,
        F.when(F.col("newest_set") == F.col("newest"), 1)
        .when(F.col("newest_cleared") == F.col("newest"), -1)
        .otherwise(0)
        .alias("transition"),
    )


def _with_net(counts: DataFrame) -> DataFrame:
    return counts.withColumns(
        {"net_slots": ex.net_slots(), "net_slots_bytes": ex.net_slots_bytes()}
    )


def address_slots_stat_per_block(
    inputs: Inputs, start: Block = None, end: Block = None, forks: Forks = MAINNET
) -> DataFrame:
    """Slots set, cleared and net, per address and block."""
    return _with_net(
        slot_changes(inputs, start, end)
        .groupBy("block_number", "address")
        .agg(agg.slots_cleared().alias("slots_cleared"), agg.slots_set().alias("slots_set"))
        .select("address", "block_number", "slots_cleared", "slots_set")
    )


def block_slots_stat(inputs: Inputs, start: Block = None, end: Block = None, forks: Forks = MAINNET) -> DataFrame:
    """Slots set, cleared and net, per block, from the raw writes."""
    return _with_net(
        _slot_changes(inputs, start, end, "block_number")
        .groupBy("block_number")
        .agg(agg.slots_cleared().alias("slots_cleared"), agg.slots_set().alias("slots_set"))
    )


def block_slots_stat_rollup(
    inputs: Inputs, start: Block = None, end: Block = None, forks: Forks = MAINNET
) -> DataFrame:
    """The same per block, summed from the table per address."""
    return _with_net(
        inputs.scan("address_slots_stat_per_block", start, end)
        .groupBy("block_number")
        .agg(
            F.sum("slots_cleared").alias("slots_cleared"),
            F.sum("slots_set").alias("slots_set"),
        )
    )


def _destruct_keys(events: DataFrame) -> DataFrame:
    return per_key(events, ["address", "block_number", "transaction_hash"])


def pre_fork_destructs(
    inputs: Inputs, start: Block = None, end: Block = None, forks: Forks = MAINNET
) -> DataFrame:
    """Destructs before the same-transaction rule."""
    window = fork_window(start, end, before=forks.same_tx_destruct)
    if window is None:
        return inputs.empty(schemas.PRE_FORK_DESTRUCTS)
    removed = _destruct_keys(ev.union_destructs(inputs, *window, forks))
    return join_tx_index(removed, ev.tx_index(inputs, *window)).select(
        *schemas.PRE_FORK_DESTRUCTS.fieldNames()
    )


def post_fork_destructs(
    inputs: Inputs, start: Block = None, end: Block = None, forks: Forks = MAINNET
) -> DataFrame:
    """Destructs under the same-transaction rule, with creations from the contract log."""
    window = fork_window(start, end, since=forks.same_tx_destruct)
    if window is None:
        return inputs.empty(schemas.POST_FORK_DESTRUCTS)
    flagged = left_join_creation(
        _destruct_keys(ev.destructs(inputs, *window)), ev.creations(inputs, *window)
    )
    return join_tx_index(flagged, ev.tx_index(inputs, *window)).select(
        *schemas.POST_FORK_DESTRUCTS.fieldNames()
    )


def post_fork_destructs_appearances(
    inputs: Inputs, start: Block = None, end: Block = None, forks: Forks = MAINNET
) -> DataFrame:
    """The same from the appearance log: created and destructed in one transaction."""
    window = fork_window(start, end, since=forks.same_tx_destruct)
    if window is None:
        return inputs.empty(schemas.POST_FORK_DESTRUCTS)
    seen = (
        inputs.scan("address_appearances", *window)
        .where(ex.is_life_cycle())
        .select(
            ex.normalize_hex("address").alias("address"),
            "block_number",
            ex.normalize_hex("transaction_hash").alias("transaction_hash"),
            "relationship",
        )
        .groupBy("address", "block_number", "transaction_hash")
        .agg(
            agg.has_relationship("suicide").alias("destructed"),
            agg.has_relationship("create").alias("is_same_tx"),
        )
        .where("destructed")
    )
    return join_tx_index(seen, ev.tx_index(inputs, *window)).select(
        *schemas.POST_FORK_DESTRUCTS.fieldNames()
    )


def union_life_events(inputs: Inputs, start: Block = None, end: Block = None) -> DataFrame:
    """Destructs and changes of accounts as one log of dead / alive."""

    def status(name: str, index: str, is_alive) -> DataFrame:
        return inputs.scan(name, start, end).select(
            "address",
            "block_number",
            F.col(index).alias("transaction_index"),
            is_alive.alias("is_alive"),
        )

    return union_all(
        status("pre_fork_destructs", "transaction_index", F.lit(False)),
        status("post_fork_destructs", "transaction_index", ex.survives_destruct()),
        status("address_diffs", "last_tx_index", F.lit(True)),
    )


def life_codes(events: DataFrame) -> DataFrame:
    """Latest status of every address as packed numbers."""
    return per_key(events, ["address"], F.max(ex.life_code()).alias("code"), F.max(ex.wide_life_code()).alias("wide"))


def accounts_alive(inputs: Inputs, start: Block = None, end: Block = None, forks: Forks = MAINNET) -> DataFrame:
    """Latest life status of every address; dead wins a tie."""
    return life_codes(union_life_events(inputs, start, end)).select("address", *ex.decoded_life("code", "wide"))
