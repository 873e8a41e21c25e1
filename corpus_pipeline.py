"""From raw documents to training tokens, stage by stage.

Every stage takes all rows its predecessor kept and returns the columns of ``documents``,
but for the last, which returns doc_id, n_tokens and ids (little-endian unsigned 32-bit
integers) of each taken copy. Stages: toxic documents go; of equal texts one
stays; of each class of near copies one stays; sources are mixed to their target
weights (documents may go or be repeated) in training order; texts are encoded.
Null and repeated values are handled as the operators state. SQL can't express the stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from chronokey.llm import bpe_chunks, exact_dedup, mixing, ngram_join, toxicity
from chronokey.llm.common import documents, saved, small_batches
from chronokey.llm.queries import byte_vocabulary


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return toxicity.drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic"))


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return exact_dedup.exact_dedup(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return ngram_join.drop_near_copies(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return mixing.curriculum(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return bpe_chunks.bpe_encode(docs, byte_vocabulary()).select("doc_id", "n_tokens", "ids")


STAGES = [
    ("toxicity", without_toxic),
    ("exact_dedup", without_copies),
    ("ngram_join", without_near_copies),
    ("source_mixing", mixed),
    ("bpe_encode", encoded),
]

#: No stage but exact deduplication can be written in SQL; tests/llm holds the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``; each result but the last is written and read again."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
