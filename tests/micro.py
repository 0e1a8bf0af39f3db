"""Hand-made inputs of a few rows."""

from __future__ import annotations

from stateloom.schemas import SOURCES, ZERO_WORD, Forks
from stateloom.sources.inputs import Inputs

FORKS = Forks(state_clearing=20, same_tx_destruct=50)
ZERO = ZERO_WORD
ONE = "0x" + "1".rjust(64, "0")
TWO = "0x" + "2".rjust(64, "0")


def make(spark, versions=None, **rows) -> Inputs:
    """Inputs with the given rows (dicts); tables not named are empty.

    Transactions default to success, hashes to ``0xt<block>.<index>``.
    """
    tables = {}
    for name, spec in SOURCES.items():
        fields = spec.schema.fieldNames()
        schema = spec.schema
        if versions and name in versions:
            from pyspark.sql.types import LongType, StructType

            schema = StructType(list(schema)).add(versions[name], LongType())
            fields = schema.fieldNames()
        data = [tuple(row.get(f) for f in fields) for row in rows.get(name, [])]
        tables[name] = spark.createDataFrame(data, schema)
    return Inputs(tables, versions=versions)


def tx(block, index, success=True, hash=None):
    return dict(
        transaction_hash=hash or f"0xt{block}.{index}",
        transaction_index=index,
        block_number=block,
        success=success,
    )


def diff(address, block, index=0, hash=None):
    return dict(address=address, block_number=block, transaction_hash=hash or f"0xt{block}.{index}")


def contract(address, block, index=0):
    return dict(contract_address=address, block_number=block, transaction_hash=f"0xt{block}.{index}")


def write(address, slot, block, index=0, internal=0, old=ZERO, new=ONE, **more):
    return dict(
        address=address,
        slot=slot,
        block_number=block,
        transaction_index=index,
        internal_index=internal,
        transaction_hash=f"0xt{block}.{index}",
        from_value=old,
        to_value=new,
        **more,
    )


def read(address, slot, block, index=0, value=TWO):
    return dict(
        contract_address=address,
        slot=slot,
        block_number=block,
        transaction_hash=f"0xt{block}.{index}",
        value=value,
    )


def destruct(address, block, index=0, to="0xheir", value="7", kind="suicide"):
    return dict(
        action_from=address,
        action_to=to,
        action_type=kind,
        action_value=value,
        block_number=block,
        transaction_hash=f"0xt{block}.{index}",
    )


def appearance(address, block, index=0, relationship="suicide"):
    return dict(
        address=address,
        block_number=block,
        transaction_hash=f"0xt{block}.{index}",
        relationship=relationship,
    )


def rows(df, *columns):
    """Rows as a sorted list of tuples."""
    return sorted(tuple(r) for r in df.select(*(columns or df.columns)).collect())
