"""Canonical inputs derived from the given tables.

Each view is one SELECT whose expressions mean the same in Spark SQL and in
DuckDB, so the queries and their oracle start from the same rows.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession

from stateloom.schemas import SOURCES, ZERO_WORD, Forks
from stateloom.sources.inputs import Inputs

FORKS = Forks(state_clearing=20, same_tx_destruct=50)
# Into how many chunks the incremental queries cut the range of the data.
CHUNKS = 3


def _padded(key: str, width: int) -> str:
    """Decimal text of a key, filled with zeros from the left.

    The filler is as wide as the result, so it is copied once and not digit by
    digit. The keys are never null; saying so spares a null test that would
    build the text a second time.
    """
    return f"lpad(coalesce(cast({key} as string), ''), {width}, '{'0' * width}')"


def _address(key: str, prefix: str) -> str:
    return f"concat('{prefix}', {_padded(key, 38)})"


def _word(key: str, prefix: str = "0x") -> str:
    return f"concat('{prefix}', {_padded(key, 62)})"


def _block(key: str) -> str:
    return f"cast(floor({key} / 10) as bigint)"


_STRETCHED = "cast(event_id + floor(event_id / 2) as bigint)"
_EVEN_STRETCHED = f"cast(2 * floor({_STRETCHED} / 2) as bigint)"
_VERSION = (
    "cast(l_partkey * 1000000 + cast(l_quantity as int) * 1000"
    " + cast(round(l_discount * 100) as int) * 10 + cast(round(l_tax * 100) as int) as bigint)"
)


@dataclass(frozen=True)
class View:
    table: str
    columns: dict[str, str]
    where: str | None = None

    def sql(self) -> str:
        columns = ", ".join(f"{expr} AS {name}" for name, expr in self.columns.items())
        return f"SELECT {columns} FROM {self.table}" + (f" WHERE {self.where}" if self.where else "")


VIEWS: dict[str, View] = {
    "transaction": View(
        "orders",
        {
            "transaction_hash": _word("o_orderkey", "0xAB"),
            "transaction_index": "o_orderkey % 10",
            "block_number": _block("o_orderkey"),
            "success": "o_orderstatus <> 'F'",
        },
    ),
    "balance_diffs": View(
        "orders",
        {
            "address": _address("o_custkey", "0xCD"),
            "block_number": _block("o_orderkey"),
            "transaction_hash": _word("o_orderkey", "0xab"),
        },
    ),
    "nonce_diffs": View(
        "orders",
        {
            "address": _address("o_custkey", "0xcd"),
            "block_number": _block("o_orderkey"),
            "transaction_hash": _word("o_orderkey", "0xAB"),
        },
        "o_orderpriority LIKE '1%'",
    ),
    "storage_diffs": View(
        "lineitem",
        {
            "address": _address("l_suppkey", "0xCD"),
            "slot": _word("l_partkey % 7"),
            "block_number": _block("l_orderkey"),
            "transaction_index": "l_orderkey % 10",
            "internal_index": "cast(l_linenumber as bigint)",
            "transaction_hash": _word("l_orderkey", "0xab"),
            "from_value": f"CASE WHEN l_returnflag = 'N' THEN '{ZERO_WORD}'"
            f" ELSE {_word('cast(l_quantity as int)')} END",
            "to_value": f"CASE WHEN l_linestatus = 'F' THEN '{ZERO_WORD}' ELSE {_word('l_partkey')} END",
            "ver": _VERSION,
        },
    ),
    "storage_reads": View(
        "events",
        {
            "contract_address": _address("user_id", "0xcd"),
            "slot": _word("event_id % 7"),
            "block_number": _block(_STRETCHED),
            "transaction_hash": _word(_STRETCHED, "0xAB"),
            "value": "props",
        },
    ),
    "balance_reads": View(
        "events",
        {
            "address": _address("user_id", "0xCD"),
            "block_number": _block("event_id"),
            "transaction_hash": _word("event_id", "0xAB"),
        },
        "event_type = 'view'",
    ),
    "nonce_reads": View(
        "events",
        {
            "address": _address("user_id", "0xCD"),
            "block_number": _block("event_id"),
            "transaction_hash": _word("event_id", "0xAB"),
        },
        "event_type = 'click'",
    ),
    "contracts": View(
        "events",
        {
            "contract_address": _address("user_id", "0xCD"),
            "block_number": _block(_STRETCHED),
            "transaction_hash": _word(_STRETCHED, "0xAB"),
        },
        "event_type IN ('signup', 'error') AND event_id % 3 = 0",
    ),
    "traces": View(
        "events",
        {
            "action_from": _address("user_id", "0xCD"),
            "action_to": _address("user_id + 1", "0xCD"),
            "action_type": "CASE WHEN event_type = 'error' THEN 'suicide' ELSE 'call' END",
            "action_value": "CASE WHEN event_id % 2 = 0 THEN '0' ELSE '7' END",
            "block_number": _block(_STRETCHED),
            "transaction_hash": _word(_STRETCHED, "0xAB"),
        },
    ),
    "address_appearances": View(
        "events",
        {
            "address": _address("user_id % 3", "0xCD"),
            "block_number": _block(_STRETCHED),
            "transaction_hash": _word(_EVEN_STRETCHED, "0xAB"),
            "relationship": "CASE event_type WHEN 'error' THEN 'suicide'"
            " WHEN 'signup' THEN 'create' ELSE 'call' END",
        },
    ),
}

VERSIONS = {"storage_diffs": "ver"}


@lru_cache(maxsize=8)
def inputs(spark: SparkSession, sf_dir: str) -> Inputs:
    """The canonical inputs as lazy frames; only their plans are kept between queries."""
    given = {
        table: spark.read.parquet(f"{sf_dir}/{table}.parquet")
        for table in sorted({v.table for v in VIEWS.values()})
    }

    def derived(view: View) -> DataFrame:
        rows = given[view.table]
        if view.where:
            rows = rows.where(view.where)
        return rows.selectExpr(*(f"{expr} AS {name}" for name, expr in view.columns.items()))

    return Inputs({name: derived(VIEWS[name]) for name in SOURCES}, versions=VERSIONS)
