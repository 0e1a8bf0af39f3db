"""Table schemas, keys and protocol constants.

Block numbers, indexes and counts are all bigint: Spark has no unsigned types,
and widening avoids the wrap-around of narrow counters.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.types import (
    BooleanType,
    DataType,
    LongType,
    StringType,
    StructField,
    StructType,
)

# They must equal the on-chain protocol and the stored tables.
ZERO_WORD = "0x" + "0" * 64
MAX_BLOCK = 4294967295
BYTES_PER_SLOT = 64
ADDRESS_PARTITIONS = 16
BLOCKS_PER_BUCKET = 5_000_000
DEFAULT_STEP = 10_000
STATE_CLEARING_BLOCK = 2_675_000
SAME_TX_DESTRUCT_BLOCK = 19_426_587


@dataclass(frozen=True)
class Forks:
    """Blocks at which the rules of account destruction change.

    ``state_clearing`` (EIP-161): below it a destruct also empties a
    beneficiary that received nothing. ``same_tx_destruct`` (EIP-6780): from it
    on, a destruct removes the account only in the transaction that created it.
    """

    state_clearing: int = STATE_CLEARING_BLOCK
    same_tx_destruct: int = SAME_TX_DESTRUCT_BLOCK


MAINNET = Forks()


def _struct(**columns: DataType) -> StructType:
    return StructType([StructField(name, kind) for name, kind in columns.items()])


_S, _L, _B = StringType(), LongType(), BooleanType()

_ADDRESS_EVENT = _struct(address=_S, block_number=_L, transaction_hash=_S)
_ADDRESS_COUNT = _struct(address=_S, block_number=_L, tx_count=_L, last_tx_index=_L)
_SLOT_COUNTS = dict(slots_cleared=_L, slots_set=_L, net_slots=_L, net_slots_bytes=_L)


@dataclass(frozen=True)
class SourceSpec:
    """A canonical input: its columns and the columns that identify a row."""

    schema: StructType
    keys: tuple[str, ...]

    @classmethod
    def of(cls, schema: StructType, *keys: str) -> "SourceSpec":
        return cls(schema, keys or tuple(schema.fieldNames()))


SOURCES: dict[str, SourceSpec] = {
    "transaction": SourceSpec.of(
        _struct(transaction_hash=_S, transaction_index=_L, block_number=_L, success=_B),
        "transaction_hash",
    ),
    "balance_diffs": SourceSpec.of(_ADDRESS_EVENT),
    "balance_reads": SourceSpec.of(_ADDRESS_EVENT),
    "nonce_diffs": SourceSpec.of(_ADDRESS_EVENT),
    "nonce_reads": SourceSpec.of(_ADDRESS_EVENT),
    "storage_diffs": SourceSpec.of(
        _struct(
            address=_S,
            slot=_S,
            block_number=_L,
            transaction_index=_L,
            internal_index=_L,
            transaction_hash=_S,
            from_value=_S,
            to_value=_S,
        ),
        "address",
        "slot",
        "block_number",
        "transaction_index",
        "internal_index",
        "transaction_hash",
    ),
    "storage_reads": SourceSpec.of(
        _struct(contract_address=_S, slot=_S, block_number=_L, transaction_hash=_S, value=_S),
        "contract_address",
        "slot",
        "transaction_hash",
    ),
    "contracts": SourceSpec.of(
        _struct(contract_address=_S, block_number=_L, transaction_hash=_S),
        "contract_address",
        "transaction_hash",
    ),
    "traces": SourceSpec.of(
        _struct(
            action_from=_S,
            action_to=_S,
            action_type=_S,
            action_value=_S,
            block_number=_L,
            transaction_hash=_S,
        )
    ),
    "address_appearances": SourceSpec.of(
        _struct(address=_S, block_number=_L, transaction_hash=_S, relationship=_S)
    ),
}

PLAIN_ACCOUNTS = _struct(address=_S)

ADDRESS_DIFFS = _ADDRESS_COUNT
ADDRESS_READS = _ADDRESS_COUNT
ADDRESS_FIRST_ACCESS = _struct(address=_S, block_number=_L, version=_L)
ADDRESS_LAST_ACCESS = _struct(address=_S, block_number=_L, is_deleted=_B)
SLOT_FIRST_ACCESS = _struct(address=_S, slot_key=_S, block_number=_L, value=_S, version=_L)
SLOT_LAST_ACCESS = _struct(address=_S, slot_key=_S, block_number=_L, value=_S)
ADDRESS_SLOTS_STAT = _struct(address=_S, block_number=_L, **_SLOT_COUNTS)
BLOCK_SLOTS_STAT = _struct(block_number=_L, **_SLOT_COUNTS)
PRE_FORK_DESTRUCTS = _struct(
    address=_S, block_number=_L, transaction_hash=_S, transaction_index=_L
)
POST_FORK_DESTRUCTS = _struct(
    address=_S, block_number=_L, transaction_hash=_S, transaction_index=_L, is_same_tx=_B
)
ACCOUNTS_ALIVE = _struct(address=_S, block_number=_L, is_alive=_B)
