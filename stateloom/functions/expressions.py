"""Scalar expressions over access logs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from stateloom.schemas import BYTES_PER_SLOT, MAX_BLOCK, ZERO_WORD


def normalize_hex(column: str | Column) -> Column:
    """Hex text in one case, so that equal addresses and hashes compare equal."""
    return F.lower(column)


def spread(*columns: str | Column) -> Column:
    """A number that is equal for equal keys and nearly always different for others.

    In front of keys it settles nearly every comparison of a sort; the keys behind it decide.
    """
    return F.xxhash64(*columns)


def digest(*columns: str | Column) -> tuple[Column, Column]:
    """128 bits that stand for some columns where only their identity matters; a null differs from all values."""
    values = [F.col(c) if isinstance(c, str) else c for c in columns]
    marked = [*values, *(v.isNull() for v in values)]
    return F.xxhash64(*marked), F.xxhash64(F.lit(1), *marked)


def transaction_id(transaction_hash: str | Column = "transaction_hash") -> tuple[Column, Column]:
    """128 bits that stand for a transaction, spelled in any case; null without a hash, so that it joins nothing."""
    spelled = normalize_hex(transaction_hash)
    first, second = digest(spelled)
    return F.when(spelled.isNotNull(), first).alias("tx_1"), F.when(spelled.isNotNull(), second).alias("tx_2")


def slot_transition(from_value: str = "from_value", to_value: str = "to_value") -> Column:
    """1 when a write fills an empty slot, -1 when it empties one, else 0."""
    was_empty = F.col(from_value) == ZERO_WORD
    is_empty = F.col(to_value) == ZERO_WORD
    return F.when(was_empty & ~is_empty, 1).when(~was_empty & is_empty, -1).otherwise(0)


def inverse_version(block_number: str = "block_number") -> Column:
    """A version that grows as the block gets smaller: the earliest row wins."""
    return F.lit(MAX_BLOCK).cast("long") - F.col(block_number)


def net_slots(slots_set: str = "slots_set", slots_cleared: str = "slots_cleared") -> Column:
    return F.col(slots_set) - F.col(slots_cleared)


def net_slots_bytes(slots_set: str = "slots_set", slots_cleared: str = "slots_cleared") -> Column:
    return net_slots(slots_set, slots_cleared) * F.lit(BYTES_PER_SLOT).cast("long")


def read_position(first: bool) -> Column:
    """In-block position given to a read so that a write of the same block wins.

    Reads carry no position of their own: they sort after every write when the
    first access is wanted and before every write when the last one is.
    """
    return F.lit(MAX_BLOCK if first else 0).cast("long")


def is_destruct() -> Column:
    return F.col("action_type") == "suicide"


def moved_nothing() -> Column:
    """The value is text in the trace log."""
    return F.col("action_value") == "0"


def is_life_cycle() -> Column:
    return F.col("relationship").isin("create", "suicide")


def survives_destruct(is_same_tx: str = "is_same_tx") -> Column:
    """A late-rules destruct kills only an account created in the same transaction."""
    return ~F.coalesce(F.col(is_same_tx), F.lit(False))


#: Room for an index and the dead flag in a wide life code.
_WIDE = "18446744073709551616BD"


def life_code(
    block_number: str = "block_number",
    transaction_index: str = "transaction_index",
    is_alive: str = "is_alive",
) -> Column:
    """(block, index, dead) as one ordered bigint, null where that does not fit.

    A maximum over a number stays a hash aggregate, a maximum over a struct
    needs a sort. The block takes 32 bits, the index 31, the dead flag 1. Rows
    beyond that, or without an index, have a ``wide_life_code``.
    """
    block, index = F.col(block_number), F.col(transaction_index)
    return F.when(_narrow(block, index), (block - 2**31) * F.lit(2**32).cast("long") + index * 2 + _dead(is_alive))


def wide_life_code(
    block_number: str = "block_number",
    transaction_index: str = "transaction_index",
    is_alive: str = "is_alive",
) -> Column:
    """The same order for any 64-bit index, as a decimal, where ``life_code`` is null.

    A missing index comes before all others of its block.
    """
    block, index = F.col(block_number), F.col(transaction_index)
    rest = (F.coalesce(index.cast("decimal(20,0)"), F.lit(-1)) + 1) * 2 + _dead(is_alive)
    code = block.cast("decimal(18,0)") * F.expr(_WIDE) + rest
    return F.when(~_narrow(block, index) & block.isNotNull(), code.cast("decimal(38,0)"))


def _narrow(block: Column, index: Column) -> Column:
    fits = block.between(0, MAX_BLOCK) & index.between(0, 2**31 - 1)
    return F.coalesce(fits, F.lit(False))


def _dead(is_alive: str) -> Column:
    return F.when(F.col(is_alive), 0).otherwise(1)


def decoded_life(code: str, wide: str) -> tuple[Column, Column]:
    """``block_number`` and ``is_alive`` of the later of a life code and a wide one."""
    one = F.lit(1).cast("long")
    narrow = F.when(
        F.col(code).isNotNull(),
        F.struct(
            (F.shiftright(code, 32) + F.lit(2**31).cast("long")).alias("block"),
            F.shiftright(F.col(code).bitwiseAND(F.lit(2**32 - 1).cast("long")), 1).cast("decimal(20,0)").alias("index"),
            (F.col(code).bitwiseAND(one) == 1).alias("dead"),
        ),
    )
    rest = F.expr(f"{wide} % {_WIDE}")
    far = F.when(
        F.col(wide).isNotNull(),
        F.struct(
            F.expr(f"{wide} div {_WIDE}").cast("long").alias("block"),
            (F.floor(rest / 2) - 1).cast("decimal(20,0)").alias("index"),
            (rest % 2 == 1).alias("dead"),
        ),
    )
    last = F.greatest(narrow, far)
    return last["block"].alias("block_number"), (~last["dead"]).alias("is_alive")
