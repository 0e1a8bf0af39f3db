"""From raw documents to token files: five stages, each over all that the one before kept."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from stateloom.llm import token_files
from stateloom.llm.decontamination import without_contamination
from stateloom.llm.jaccard import without_near_copies
from stateloom.llm.labelled import table
from stateloom.llm.mixing import mixed_documents
from stateloom.llm.queries import tokenizer
from stateloom.llm.storage import stored
from stateloom.llm.toxicity import toxicity
from stateloom.ship import ship
from stateloom.sources.files import shared_dir


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity models do not reject."""
    scored = toxicity(docs, table(spark, sf_dir, "labels"))
    return scored.where("tox_predicted = 0").select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked ones, that with the smallest id; all rows of a null id.

    Near copies share five-word shingles by a Jaccard of 0.8, as benchmark passages do.

    Rows that repeat an id with the same shingles become one row; other texts of the
    id are documents of their own.
    """
    return without_near_copies(docs, n=5, percent=80)


def drop_benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark."""
    return without_contamination(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the mix takes of each document, its text cut and repeated accordingly."""
    return mixed_documents(docs)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, read back from its token files."""
    return token_files.contract(docs, tokenizer("word_bpe_49k.json"))


#: Bytes of an Arrow batch between Spark and Python: batches of long texts take several times as much in buffers.
BATCH_BYTES = 4 << 20


def _in_small_batches(stage: Callable[[SparkSession, DataFrame, str], DataFrame]):
    """The stage, with Arrow batches of the session bounded where it leaves them at Spark's own 64 MB."""

    @functools.wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        name = "spark.sql.execution.arrow.maxBytesPerBatch"
        if spark.conf.get(name).rstrip("b") == str(64 << 20):
            spark.conf.set(name, str(BATCH_BYTES))
        return stage(spark, docs, sf_dir)

    return run_stage


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", drop_near_copies),
    ("decontamination", drop_benchmark_passages),
    ("mixing", mix_sources),
    ("token_files", write_tokens),
]
STAGES = [(name, _in_small_batches(stage)) for name, stage in STAGES]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each result is written to the shared folder and read again."""
    ship(spark)
    folder = shared_dir(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), folder, name)
    return docs


#: Classifiers, fuzzy windows and tokenizers have no counterpart in SQL.
ORACLE_SQL: str | None = None
