"""What can be built: every derived table with its inputs, layout and keys."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from stateloom import schemas
from stateloom.operators.blocks import fork_window
from stateloom.plans import tables
from stateloom.schemas import DEFAULT_STEP, Forks
from stateloom.sources.inputs import Inputs

FACTS = "facts"
STATE = "state"

Build = Callable[[Inputs, int, int, Forks], DataFrame]


def _no_note(start: int, end: int, forks: Forks) -> str:
    return ""


def _whole_range(start: int, end: int, forks: Forks):
    return start, end


def _before_fork(start: int, end: int, forks: Forks):
    return fork_window(start, end, before=forks.same_tx_destruct)


def _since_fork(start: int, end: int, forks: Forks):
    return fork_window(start, end, since=forks.same_tx_destruct)


def early_note(start: int, end: int, forks: Forks) -> str:
    return "pre-EIP-161" if end < forks.state_clearing else ""


def fork_note(start: int, end: int, forks: Forks) -> str:
    if end < forks.same_tx_destruct:
        return "pre-EIP-6780"
    return "post-EIP-6780" if start >= forks.same_tx_destruct else "spans EIP-6780"


@dataclass(frozen=True)
class TableSpec:
    """A derived table.

    ``inputs`` are all tables the plan reads; ``coverage`` are those that bound
    how far it can be built (all inputs unless stated). Facts are stored by
    buckets of ``bucket_width`` blocks, state by ``keys`` with the highest
    ``version`` winning. ``window`` is the part of a range that has any rows.
    ``spread_out`` says that the plan ends behind a shuffle by several columns.
    """

    key: str
    description: str
    inputs: tuple[str, ...]
    build: Build
    schema: StructType
    kind: str
    keys: tuple[str, ...]
    version: str | None = None
    coverage: tuple[str, ...] = ()
    bucket_width: int = DEFAULT_STEP
    note: Callable[[int, int, Forks], str] = _no_note
    window: Callable[[int, int, Forks], tuple | None] = _whole_range
    info: Mapping[str, Any] = field(default_factory=dict)
    spread_out: bool = False

    def __post_init__(self):
        if self.kind not in (FACTS, STATE):
            raise ValueError(f"{self.key}: kind must be {FACTS} or {STATE}")
        if self.kind == STATE and self.version is None:
            raise ValueError(f"{self.key}: a state table needs a version column")

    @property
    def coverage_inputs(self) -> tuple[str, ...]:
        return self.coverage or self.inputs


_DIFFS = ("balance_diffs", "storage_diffs", "nonce_diffs", "contracts")
_READS = ("balance_reads", "nonce_reads", "storage_reads")
_SLOTS = ("storage_diffs", "storage_reads", "transaction")
_ADDRESS_FACT = dict(kind=FACTS, keys=("address", "block_number"), spread_out=True)
_ADDRESS_STATE = dict(kind=STATE, keys=("address",))
_SLOT_STATE = dict(kind=STATE, keys=("address", "slot_key"))
_DESTRUCT_FACT = dict(kind=FACTS, keys=("address", "block_number", "transaction_hash"))

TABLES: dict[str, TableSpec] = {
    spec.key: spec
    for spec in (
        TableSpec(
            "address_diffs",
            "Transactions that changed an address, per block",
            (*_DIFFS, "transaction"),
            tables.address_diffs,
            schemas.ADDRESS_DIFFS,
            **_ADDRESS_FACT,
        ),
        TableSpec(
            "address_reads",
            "Transactions that read an address, per block",
            (*_READS, "transaction"),
            tables.address_reads,
            schemas.ADDRESS_READS,
            **_ADDRESS_FACT,
        ),
        TableSpec(
            "address_first_access",
            "First block in which an address was touched",
            (*_DIFFS, *_READS, "transaction"),
            tables.address_first_access,
            schemas.ADDRESS_FIRST_ACCESS,
            version="version",
            **_ADDRESS_STATE,
        ),
        TableSpec(
            "address_last_access",
            "Last block in which an address was touched",
            (*_DIFFS, *_READS, "transaction"),
            tables.address_last_access,
            schemas.ADDRESS_LAST_ACCESS,
            version="block_number",
            **_ADDRESS_STATE,
        ),
        TableSpec(
            "slot_first_access_ordered",
            "First access of a storage slot, in execution order",
            _SLOTS,
            tables.slot_first_access_ordered,
            schemas.SLOT_FIRST_ACCESS,
            version="version",
            **_SLOT_STATE,
        ),
        TableSpec(
            "slot_last_access_ordered",
            "Last access of a storage slot, in execution order",
            _SLOTS,
            tables.slot_last_access_ordered,
            schemas.SLOT_LAST_ACCESS,
            version="block_number",
            **_SLOT_STATE,
        ),
        TableSpec(
            "slot_first_access_success",
            "First access of a storage slot by a successful transaction",
            _SLOTS,
            tables.slot_first_access_success,
            schemas.SLOT_FIRST_ACCESS,
            version="version",
            **_SLOT_STATE,
        ),
        TableSpec(
            "slot_last_access_success",
            "Last access of a storage slot by a successful transaction",
            _SLOTS,
            tables.slot_last_access_success,
            schemas.SLOT_LAST_ACCESS,
            version="block_number",
            **_SLOT_STATE,
        ),
        TableSpec(
            "address_slots_stat_per_block",
            "Slots set and cleared, per address and block",
            ("storage_diffs", "transaction"),
            tables.address_slots_stat_per_block,
            schemas.ADDRESS_SLOTS_STAT,
            **_ADDRESS_FACT,
        ),
        TableSpec(
            "block_slots_stat",
            "Slots set and cleared, per block",
            ("storage_diffs", "transaction"),
            tables.block_slots_stat,
            schemas.BLOCK_SLOTS_STAT,
            kind=FACTS,
            keys=("block_number",),
        ),
        TableSpec(
            "block_slots_stat_rollup",
            "Slots set and cleared, per block, from the table per address",
            ("address_slots_stat_per_block",),
            tables.block_slots_stat_rollup,
            schemas.BLOCK_SLOTS_STAT,
            kind=FACTS,
            keys=("block_number",),
        ),
        TableSpec(
            "pre_fork_destructs",
            "Destructed accounts before the same-transaction rule",
            ("traces", "transaction"),
            tables.pre_fork_destructs,
            schemas.PRE_FORK_DESTRUCTS,
            window=_before_fork,
            note=early_note,
            info={"rule changes": "EIP-161, EIP-6780"},
            **_DESTRUCT_FACT,
        ),
        TableSpec(
            "post_fork_destructs",
            "Destructed accounts since the same-transaction rule",
            ("traces", "contracts", "transaction"),
            tables.post_fork_destructs,
            schemas.POST_FORK_DESTRUCTS,
            window=_since_fork,
            info={"rule change": "EIP-6780"},
            **_DESTRUCT_FACT,
        ),
        TableSpec(
            "post_fork_destructs_appearances",
            "Destructed accounts since the same-transaction rule, from appearances",
            ("address_appearances", "transaction"),
            tables.post_fork_destructs_appearances,
            schemas.POST_FORK_DESTRUCTS,
            window=_since_fork,
            info={"rule change": "EIP-6780"},
            **_DESTRUCT_FACT,
        ),
        TableSpec(
            "accounts_alive",
            "Latest life status of every account",
            ("address_diffs", "pre_fork_destructs", "post_fork_destructs"),
            tables.accounts_alive,
            schemas.ACCOUNTS_ALIVE,
            version="block_number",
            note=fork_note,
            info={"rule change": "EIP-6780", "order": "block, transaction index, dead last"},
            **_ADDRESS_STATE,
        ),
    )
}

# Table names under which the derived data is also known.
ALIASES = {
    "address_storage_slot_first_access": "slot_first_access_success",
    "address_storage_slot_last_access": "slot_last_access_success",
    "pre_6780_accounts_destructs": "pre_fork_destructs",
    "post_6780_accounts_destructs": "post_fork_destructs",
}


def resolve(registry: Mapping[str, TableSpec], key: str) -> TableSpec:
    name = ALIASES.get(key, key)
    if name not in registry:
        raise KeyError(f"unknown table: {key}; known are {', '.join(sorted(registry))}")
    return registry[name]


def in_dependency_order(registry: Mapping[str, TableSpec], keys) -> list[TableSpec]:
    """The named tables, each behind those of them it reads."""
    wanted = {resolve(registry, key).key for key in keys}
    ordered: dict[str, TableSpec] = {}

    def visit(key: str) -> None:
        # Also through tables that were not asked for: they still set the order.
        if key in registry and key not in ordered:
            for name in registry[key].inputs:
                visit(name)
            ordered[key] = registry[key]

    for spec in registry.values():
        visit(spec.key)
    return [spec for key, spec in ordered.items() if key in wanted]


def custom_table(
    key: str,
    sources: tuple[str, ...],
    schema: StructType,
    fn: Callable[[dict[str, DataFrame], int, int], DataFrame],
    keys: tuple[str, ...],
    description: str = "",
    kind: str = FACTS,
    merged: bool = True,
    **options,
) -> TableSpec:
    """A user's own table: ``fn(inputs, start, end)`` over inputs cut to the range.

    Inputs whose keys are known come as the newest copy of every row; with
    ``merged=False`` as stored, copies included.
    """

    def build(inputs: Inputs, start: int, end: int, forks: Forks) -> DataFrame:
        cut = {
            name: inputs.latest(name, start, end) if merged and name in inputs.keys else inputs.scan(name, start, end)
            for name in sources
        }
        return fn(cut, start, end).select(*schema.fieldNames())

    return TableSpec(key, description or key, tuple(sources), build, schema, kind, tuple(keys), **options)
