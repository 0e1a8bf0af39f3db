"""Every registered query against its SQL counterpart on the given tables."""

from __future__ import annotations

import os

import compare
import pytest

import __spark_entry__ as contract
from workload.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def oracle():
    connection = compare.connect(SF_DIR)
    yield connection
    connection.close()


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(contract.queries())
    assert set(QUERIES) <= set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_oracle(spark, oracle, name):
    df = contract.queries()[name](spark, SF_DIR)
    assert compare.difference(df, oracle, contract.oracle_sql()[name]) is None


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["address", "block_number", "tx_count", "last_tx_index"]
    assert df.count() > 0
