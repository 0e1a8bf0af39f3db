"""How often the rows of a log travel in plans without broadcasts."""

from __future__ import annotations

import re

from micro import diff, make, rows, tx, write
from test_plans import conf, no_broadcast, plan

from stateloom.operators.unions import union_all
from stateloom.plans import events as ev
from stateloom.plans import tables


def micro_inputs(spark):
    return make(
        spark,
        transaction=[tx(5, 0), tx(6, 0, success=False), tx(7, 0), tx(7, 1)],
        balance_diffs=[diff("0xa", 5), diff("0xA", 5), diff("0xb", 6), diff("0xa", 7, hash="0xT7.0"), diff("0xa", 7, hash="0xt7.1")],
        nonce_diffs=[diff("0xa", 7, hash="0xt7.0"), diff("0xb", 5)],
    )


def shuffles(text: str) -> list[str]:
    return re.findall(r"Exchange hashpartitioning\((.*?), \d+\)", text)


def test_events_travel_to_their_transactions_and_to_their_group(spark):
    i = micro_inputs(spark)
    with no_broadcast(spark):
        for key in ("address_diffs", "address_reads"):
            found = shuffles(plan(getattr(tables, key)(i)))
            # Events, transactions (for one row a hash, and for the join), and what the join left.
            assert len(found) == 4 and found[0].startswith("block_number"), (key, found)
        for key in ("address_first_access", "address_last_access"):
            found = shuffles(plan(getattr(tables, key)(i)))
            assert len(found) == 4 and "address" in found[0], (key, found)


def test_first_and_last_blocks_share_the_shuffle_of_events(spark):
    i = micro_inputs(spark)
    with no_broadcast(spark), conf(spark, spark__sql__adaptive__enabled=False):
        first, last = tables.address_first_access(i), tables.address_last_access(i)
        both = union_all(first.select("address", "block_number"), last.select("address", "block_number"))
        text = plan(both)
        assert text.count("ReusedExchange") >= 2
        assert rows(both) == [("0xa", 5), ("0xa", 7), ("0xb", 5), ("0xb", 5)]


def test_repeats_of_a_transaction_count_once(spark):
    i = micro_inputs(spark)
    want = [("0xa", 5, 1, 0), ("0xa", 7, 2, 1), ("0xb", 5, 1, 0)]
    assert rows(tables.address_diffs(i)) == want
    with no_broadcast(spark):
        assert rows(tables.address_diffs(i)) == want


def test_copies_are_sorted_once_behind_their_shuffle(spark):
    writes = [write("0xa", "s", 5, v=1), write("0xa", "s", 5, v=2, new="0x2"), write("0xa", "s", 6, v=1), write(None, None, 7, v=1)]
    i = make(spark, versions={"storage_diffs": "v"}, transaction=[tx(5, 0), tx(6, 0, success=False), tx(7, 0)], storage_diffs=writes)
    text = plan(i.latest("storage_diffs", None, None, "to_value"))
    assert text.count("Sort [") == 1 and text.index("Sort [") < text.index("Exchange hashpartitioning(address_spread")
    got = rows(i.latest("storage_diffs", None, None, "to_value"), "block_number", "to_value")
    assert len(got) == 3 and (5, "0x2") in got
    assert rows(ev.successful_storage_accesses(i, None, None), "block_number")
