"""From raw documents to packed training sequences, stage by stage.

Each stage takes the session, the documents its predecessor kept (read from Parquet)
and the folder of the given tables. All stages but the last return whole rows of
``documents``: quality rules drop rows, exact and near-duplicate removal keep one row of
each group, the secret scan replaces secrets in the texts. Packing returns the pieces.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from bidlens.llm import dedup, jaccard, packing, quality, secret_scan
from bidlens.llm.base import table
from bidlens.session import settled

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

# Bytes of rows sent to a Python worker at once. Executors and workers hold a few such batches for each running task and
# keep their memory for the next stage.
BATCH_BYTES = 4 << 20


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return dedup.keep_one_of_each(docs)


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Five-word shingles, similarity of 0.8 or more."""
    return jaccard.keep_one_of_each(docs, k=5, num=80, den=100)


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secret_scan.redact(docs)


def pack_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules), ("exact_dedup", exact_dedup), ("jaccard_join", jaccard_join),
    ("secret_scans", secret_scans), ("packing", pack_documents),
]

ORACLE_SQL = None  # the tokenizer and the suffix array have no SQL; tests/llm/test_pipeline.py checks all stages


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Rows travel to Python workers in batches of at most ``BATCH_BYTES``, or a row, within this block."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(BATCH_BYTES))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of all documents that stay, each stage written and read again; only the last stage's table is left."""
    def stages() -> DataFrame:
        docs = table(spark, sf_dir, "documents")
        for name, stage in STAGES:
            docs = settled(spark, partial(stage, spark, docs, sf_dir), name)
        return docs

    with small_batches(spark):
        return settled(spark, stages, "pieces")
