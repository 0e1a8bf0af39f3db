"""Small cases with written-out results."""

from __future__ import annotations

import pytest
from micro import (
    FORKS,
    ONE,
    TWO,
    ZERO,
    appearance,
    contract,
    destruct,
    diff,
    make,
    read,
    rows,
    tx,
    write,
)

from stateloom.plans import tables
from stateloom.schemas import MAX_BLOCK


def alive(spark, **events):
    i = make(spark, **events)
    derived = {
        n: getattr(tables, n)(i, forks=FORKS)
        for n in ("address_diffs", "pre_fork_destructs", "post_fork_destructs")
    }
    return rows(tables.accounts_alive(i.with_tables(derived), forks=FORKS))


def test_dead_wins_a_tie(spark):
    got = alive(
        spark,
        transaction=[tx(10, 3)],
        balance_diffs=[diff("0xa", 10, 3)],
        traces=[destruct("0xa", 10, 3)],
    )
    assert got == [("0xa", 10, False)]


@pytest.mark.parametrize("dies, changes, is_alive", [(3, 5, True), (5, 3, False)])
def test_later_index_decides(spark, dies, changes, is_alive):
    got = alive(
        spark,
        transaction=[tx(10, 3), tx(10, 5)],
        balance_diffs=[diff("0xa", 10, changes)],
        traces=[destruct("0xa", 10, dies)],
    )
    assert got == [("0xa", 10, is_alive)]


def test_late_destruct_needs_creation_in_the_same_transaction(spark):
    i = make(
        spark,
        transaction=[tx(60, 1), tx(60, 2)],
        contracts=[contract("0xA", 60, 1), contract("0xB", 60, 1)],
        traces=[destruct("0xa", 60, 1), destruct("0xb", 60, 2)],
    )
    assert rows(tables.post_fork_destructs(i, forks=FORKS)) == [
        ("0xa", 60, "0xt60.1", 1, True),
        ("0xb", 60, "0xt60.2", 2, False),
    ]
    got = alive(
        spark,
        transaction=[tx(60, 1), tx(60, 2)],
        contracts=[contract("0xa", 60, 1), contract("0xb", 60, 1)],
        traces=[destruct("0xa", 60, 1), destruct("0xb", 60, 2)],
    )
    assert got == [("0xa", 60, False), ("0xb", 60, True)]


def test_appearances_form(spark):
    i = make(
        spark,
        transaction=[tx(60, 1), tx(60, 2), tx(60, 3, success=False), tx(49, 0)],
        address_appearances=[
            appearance("0xA", 60, 1, "create"),
            appearance("0xa", 60, 1),
            appearance("0xb", 60, 2),
            appearance("0xb", 60, 1, "create"),
            appearance("0xc", 60, 2, "call"),
            appearance("0xd", 60, 3),
            appearance("0xe", 49, 0),
        ],
    )
    assert rows(tables.post_fork_destructs_appearances(i, forks=FORKS)) == [
        ("0xa", 60, "0xt60.1", 1, True),
        ("0xb", 60, "0xt60.2", 2, False),
    ]


def test_write_beats_read_of_its_block(spark):
    i = make(
        spark,
        transaction=[tx(5, 0), tx(5, 1)],
        storage_diffs=[write("0xa", "s", 5, 1, internal=7)],
        storage_reads=[read("0xA", "s", 5, 0)],
    )
    assert rows(tables.slot_first_access_ordered(i)) == [("0xa", "s", 5, ONE, MAX_BLOCK - 5)]
    assert rows(tables.slot_last_access_ordered(i)) == [("0xa", "s", 5, ONE)]


def test_position_orders_writes(spark):
    i = make(
        spark,
        transaction=[tx(5, 0), tx(5, 1)],
        storage_diffs=[
            write("0xa", "s", 5, 1, internal=1, new="c"),
            write("0xa", "s", 5, 0, internal=9, new="b"),
            write("0xa", "s", 5, 0, internal=2, new="z"),
        ],
    )
    assert rows(tables.slot_first_access_ordered(i), "value") == [("z",)]
    assert rows(tables.slot_last_access_ordered(i), "value") == [("c",)]


def test_failed_write_counts_in_the_ordered_form_only(spark):
    i = make(
        spark,
        transaction=[tx(5, 0, success=False)],
        storage_diffs=[write("0xa", "s", 5)],
        balance_diffs=[diff("0xa", 5)],
    )
    assert rows(tables.slot_first_access_ordered(i), "address") == [("0xa",)]
    assert rows(tables.slot_last_access_ordered(i), "address") == [("0xa",)]
    for name in (
        "slot_first_access_success",
        "slot_last_access_success",
        "address_diffs",
        "address_first_access",
        "address_last_access",
        "address_slots_stat_per_block",
        "block_slots_stat",
    ):
        assert rows(getattr(tables, name)(i)) == [], name


def test_failed_read_never_counts(spark):
    i = make(spark, transaction=[tx(5, 0, success=False)], storage_reads=[read("0xa", "s", 5)])
    for name in (
        "slot_first_access_ordered",
        "slot_last_access_ordered",
        "slot_first_access_success",
        "slot_last_access_success",
        "address_reads",
        "address_first_access",
        "address_last_access",
    ):
        assert rows(getattr(tables, name)(i)) == [], name


def test_slot_transitions(spark):
    i = make(
        spark,
        transaction=[tx(5, 0), tx(6, 0)],
        storage_diffs=[
            write("0xa", "1", 5, internal=1, old=ZERO, new=ONE),
            write("0xa", "2", 5, internal=2, old=ZERO, new=TWO),
            write("0xa", "3", 5, internal=3, old=ONE, new=ZERO),
            write("0xb", "1", 5, internal=4, old=ONE, new=TWO),
            write("0xb", "2", 5, internal=5, old=ZERO, new=ZERO),
            write("0xb", "2", 6, internal=5, old=ONE, new=ZERO),
        ],
    )
    assert rows(tables.address_slots_stat_per_block(i)) == [
        ("0xa", 5, 1, 2, 1, 64),
        ("0xb", 5, 0, 0, 0, 0),
        ("0xb", 6, 1, 0, -1, -64),
    ]
    assert rows(tables.block_slots_stat(i)) == [(5, 1, 2, 1, 64), (6, 1, 0, -1, -64)]


def test_fork_edges(spark):
    blocks = [FORKS.state_clearing - 1, FORKS.state_clearing, FORKS.same_tx_destruct - 1, FORKS.same_tx_destruct]
    i = make(
        spark,
        transaction=[tx(b, 0) for b in blocks],
        traces=[destruct("0xa", b, to="0xHEIR", value=v) for b in blocks for v in ("0", "7")],
    )
    assert rows(tables.pre_fork_destructs(i, forks=FORKS), "address", "block_number") == [
        ("0xa", 19),
        ("0xa", 20),
        ("0xa", 49),
        ("0xheir", 19),
    ]
    assert rows(tables.post_fork_destructs(i, forks=FORKS), "address", "block_number") == [("0xa", 50)]
    assert rows(tables.pre_fork_destructs(i, 50, 60, FORKS)) == []
    assert rows(tables.post_fork_destructs(i, 0, 49, FORKS)) == []


def test_heir_of_a_paid_destruct_lives(spark):
    i = make(spark, transaction=[tx(5, 0)], traces=[destruct("0xa", 5, to="0xb", value="7")])
    assert rows(tables.pre_fork_destructs(i, forks=FORKS), "address") == [("0xa",)]


def test_case_of_hex_is_irrelevant(spark):
    i = make(
        spark,
        transaction=[tx(5, 2, hash="0xABC")],
        balance_diffs=[diff("0xAa", 5, hash="0xabc"), diff("0xaA", 5, hash="0xAbC")],
        nonce_diffs=[diff("0xaa", 5, hash="0xABC")],
        balance_reads=[diff("0xAA", 5, hash="0xaBC")],
    )
    assert rows(tables.address_diffs(i)) == [("0xaa", 5, 1, 2)]
    assert rows(tables.address_reads(i)) == [("0xaa", 5, 1, 2)]
    assert rows(tables.address_first_access(i)) == [("0xaa", 5, MAX_BLOCK - 5)]
    assert rows(tables.address_last_access(i)) == [("0xaa", 5, False)]


def test_copies_do_not_count_twice(spark):
    twice = lambda *events: [*events, *events]
    i = make(
        spark,
        transaction=twice(tx(5, 0), tx(5, 1)),
        balance_diffs=twice(diff("0xa", 5, 0), diff("0xa", 5, 1)),
        storage_diffs=twice(write("0xa", "s", 5)),
        traces=twice(destruct("0xa", 60)),
        contracts=twice(contract("0xa", 5)),
    )
    assert rows(tables.address_diffs(i)) == [("0xa", 5, 2, 1)]
    assert rows(tables.address_slots_stat_per_block(i)) == [("0xa", 5, 0, 1, 1, 64)]
    assert rows(tables.block_slots_stat(i)) == [(5, 0, 1, 1, 64)]


def test_newest_version_replaces_older_ones(spark):
    i = make(
        spark,
        versions={"storage_diffs": "v", "storage_reads": "v", "transaction": "v"},
        transaction=[tx(5, 0, success=False) | {"v": 1}, tx(5, 0) | {"v": 2}, tx(6, 0) | {"v": 1}, tx(6, 0, success=False) | {"v": 3}],
        storage_diffs=[
            write("0xa", "s", 5, old=ZERO, new="a", v=1),
            write("0xa", "s", 5, old=ONE, new=ZERO, v=2),
        ],
        storage_reads=[
            read("0xb", "s", 5, value="a") | {"v": 1},
            read("0xb", "s", 5, value="z") | {"v": 2},
            read("0xc", "s", 6) | {"v": 1},
        ],
    )
    assert rows(tables.address_slots_stat_per_block(i)) == [("0xa", 5, 1, 0, -1, -64)]
    for name in ("slot_first_access_ordered", "slot_first_access_success", "slot_last_access_ordered", "slot_last_access_success"):
        got = rows(getattr(tables, name)(i), "address", "slot_key", "value")
        assert got == [("0xa", "s", ZERO), ("0xb", "s", "z")], name


def test_life_beyond_the_narrow_code(spark):
    """Indexes of 64 bits, missing ones and late blocks keep their order."""
    far, late = 2**62, 2**32 + 5
    i = make(spark).with_tables(
        {
            "address_diffs": spark.createDataFrame(
                [("0xa", 1, 1, 2**31), ("0xb", 1, 1, far), ("0xc", 1, 1, None), ("0xd", late, 1, 1), ("0xe", 9, 1, 1), ("0xf", 1, 1, far)],
                "address string, block_number long, tx_count long, last_tx_index long",
            ),
            "pre_fork_destructs": spark.createDataFrame(
                [("0xb", 1, "h", far - 1), ("0xc", 1, "h", 0), ("0xd", 7, "h", 1), ("0xe", 8, "h", far), ("0xf", 1, "h", far)],
                "address string, block_number long, transaction_hash string, transaction_index long",
            ),
            "post_fork_destructs": tables.post_fork_destructs(make(spark), forks=FORKS),
        }
    )
    assert rows(tables.accounts_alive(i)) == [
        ("0xa", 1, True),
        ("0xb", 1, True),
        ("0xc", 1, False),
        ("0xd", late, True),
        ("0xe", 9, True),
        ("0xf", 1, False),
    ]


def test_life_code_at_its_limits(spark):
    top = 2**31 - 1
    i = make(spark).with_tables(
        {
            "address_diffs": spark.createDataFrame(
                [("0xa", MAX_BLOCK, 1, top), ("0xb", 0, 1, 0), ("0xc", MAX_BLOCK, 1, top - 1)],
                "address string, block_number long, tx_count long, last_tx_index long",
            ),
            "pre_fork_destructs": spark.createDataFrame(
                [("0xa", MAX_BLOCK - 1, "h", top), ("0xc", MAX_BLOCK, "h", top)],
                "address string, block_number long, transaction_hash string, transaction_index long",
            ),
            "post_fork_destructs": spark.createDataFrame(
                [("0xb", 0, "h", 0, None)],
                "address string, block_number long, transaction_hash string,"
                " transaction_index long, is_same_tx boolean",
            ),
        }
    )
    assert rows(tables.accounts_alive(i)) == [
        ("0xa", MAX_BLOCK, True),
        ("0xb", 0, True),
        ("0xc", MAX_BLOCK, False),
    ]


def test_moved_copies_count_once(spark):
    """Tables whose key does not hold the block: only the newest copy says where a row is."""
    i = make(
        spark,
        versions={"contracts": "v", "storage_reads": "v"},
        transaction=[tx(5, 0), tx(6, 0)],
        contracts=[
            contract("0xa", 5) | {"transaction_hash": "0xt1", "v": 1},
            contract("0xa", 6) | {"transaction_hash": "0xt1", "v": 2},
        ],
        storage_reads=[
            read("0xb", "s", 5) | {"transaction_hash": "0xt1", "v": 1},
            read("0xb", "s", 6) | {"transaction_hash": "0xt1", "v": 2},
        ],
    )
    assert {r["block_number"] for r in ev_rows(i, "contracts", "contract_address")} == {6}
    assert {r["block_number"] for r in ev_rows(i, "storage_reads", "contract_address")} == {6}


def ev_rows(i, name, address):
    from stateloom.plans.events import address_events

    return address_events(i, name, None, None, address).collect()
