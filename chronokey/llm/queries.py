"""The registered query of each operator, over its whole table with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe_chunks, chaining, decontamination, exact_dedup, fingerprints, licenses, merkle, mixing, ngram_join, ranking, secrets, token_store, toxicity
from .common import documents, scratch


def byte_vocabulary() -> str:
    """Path of the byte-level vocabulary file that the token queries use."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chaining.repeated_passages(documents(spark, sf_dir))


def op2_bpe_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens = bpe_chunks.bpe_encode(documents(spark, sf_dir), byte_vocabulary())
    return tokens.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                         F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"), "n_reused")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    return toxicity.toxicity(documents(spark, sf_dir), labels)


def op4_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "tokens")
    token_store.write_tokens(documents(spark, sf_dir), path, byte_vocabulary())
    tokens = token_store.read_tokens(spark, path)
    return tokens.select("doc_id", "start", (F.length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))


def op5_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.ngram_classes(documents(spark, sf_dir))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = exact_dedup.duplicate_groups(documents(spark, sf_dir))
    return groups.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_report(documents(spark, sf_dir))


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_scan(documents(spark, sf_dir)).drop("matches")


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    # Marks meet the groups as bytes; text forms are made after the join.
    marks = fingerprints.fingerprints(docs).withColumn("edited_sha256", F.unhex("edited_sha256")).drop("th")
    # Groups by id: rows that repeat an id have the same class only if their texts do, so the smallest stands.
    groups = fingerprints.fingerprint_groups(docs).groupBy(F.col("doc_id").alias("id")).agg(
        F.min("class_id").alias("class_id"), F.max("n_links").alias("n_links"))
    text = lambda c: F.lower(F.hex(c))
    return marks.join(groups, F.col("doc_id").eqNullSafe(F.col("id")), "left").select(
        "doc_id", "n_chars", text("edited_sha256").alias("edited_sha256"), text("sig").alias("fingerprint"),
        text("edited_sig").alias("edited_fingerprint"), "near_edited", "near_next", "class_id", "n_links")


def op10_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(documents(spark, sf_dir))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "copies",
                        F.get("positions", F.lit(0)).alias("position")).orderBy("position", "doc_id")


def benchmark(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text")


def op11_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contamination(documents(spark, sf_dir), benchmark(spark, sf_dir)).drop("item_ids")


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(documents(spark, sf_dir))


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.search(documents(spark, sf_dir), benchmark(spark, sf_dir))


QUERIES = {f.__name__: f for f in (op1_repeated_passages, op2_bpe_chunks, op3_toxicity, op4_token_store, op5_ngram_join, op6_exact_dedup, op7_secret_scan, op8_license_scan, op9_fingerprints, op10_source_mixing,
                                      op11_decontamination, op12_merkle_manifest, op13_ranked_search)}
