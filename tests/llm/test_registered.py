"""The registered queries on the given tables."""

import os

import compare
import pytest

import __spark_entry__ as contract
from stateloom.llm.queries import LLM_ORACLE, LLM_QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
NAMES = [*LLM_QUERIES, "pipeline"]
PER_DOCUMENT = [n for n in LLM_QUERIES if n not in ("op3_decontamination", "op12_whitening", "op13_url_filter")]


def test_one_query_for_each_operator():
    assert [n.split("_")[0] for n in LLM_QUERIES] == [f"op{k}" for k in range(1, 14)]
    assert set(NAMES) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(LLM_ORACLE))
def test_matches_oracle(spark, name):
    df = contract.queries()[name](spark, SF_DIR)
    assert compare.difference(df, compare.connect(SF_DIR), contract.oracle_sql()[name]) is None


@pytest.mark.parametrize("name", PER_DOCUMENT)
def test_one_row_for_each_document(spark, name):
    ids = [r["doc_id"] for r in contract.queries()[name](spark, SF_DIR).select("doc_id").collect()]
    documents = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    assert sorted(ids) == sorted(r["doc_id"] for r in documents.select("doc_id").collect())


def test_contaminated_documents_hold_an_item(spark):
    connection = compare.connect(SF_DIR)
    want = connection.execute(
        "SELECT DISTINCT doc_id FROM documents, benchmark WHERE contains(documents.text, benchmark.text)"
    ).fetchall()
    got = contract.queries()["op3_decontamination"](spark, SF_DIR).select("doc_id").distinct().collect()
    assert {r["doc_id"] for r in got} == {d for d, in want}


def test_pipeline_runs(spark):
    rows = contract.queries()["pipeline"](spark, SF_DIR).collect()
    assert rows and set(rows[0].asDict()) == {"doc_id", "start", "n_tokens", "ids_crc32"}
