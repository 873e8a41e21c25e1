"""Exact deduplication with a heavy-hitter split.

Texts are equal when identical after deleting space, tab, LF, VT, FF and CR.
A Misra-Gries summary finds the frequent digests. Their exact winners and counts
are verified and broadcast, so copies of hot texts are decided on the map side.
All other digests are grouped and joined by an ordinary shuffle of small rows.

Cases: a null text is empty, and empty texts are equal to each other. A null id
sorts after every other id. Of rows that tie in text and id exactly one is kept.
An empty table gives an empty result. Other columns of the input are ignored
(``exact_dedup`` returns them unchanged, whatever their names).
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import packed, saved, text_or_empty

#: Counters of a Misra-Gries summary: any digest of more than rows / (COUNTERS + 1) copies is found.
COUNTERS = 256


def normalised(text: Column) -> Column:
    return F.translate(text_or_empty(text), " \t\n\x0b\x0c\r", "")


def misra_gries(counters: int):
    """Map function: digests of a partition to at most ``counters`` (digest, count) rows."""

    def trim(held: dict) -> dict:
        if len(held) <= counters:
            return held
        cut = sorted(held.values(), reverse=True)[counters]
        return {d: n - cut for d, n in held.items() if n > cut}

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        held: dict[bytes, int] = {}
        for batch in batches:
            seen = batch.column(0).value_counts()
            for d, n in zip(seen.field("values").to_pylist(), seen.field("counts").to_pylist(), strict=True):
                held[d] = held.get(d, 0) + n
            held = trim(held)
        if held:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(held), pa.binary()), pa.array(list(held.values()), pa.int64())], ["digest", "n"])

    return run


def frequent_digests(digests: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """At most ``counters`` rows (digest); every digest above rows / (counters + 1) is among them.

    The partitions' summaries are merged by adding counts and subtracting the
    (counters + 1)-th largest, which keeps the Misra-Gries guarantee.
    """
    spark = digests.sparkSession
    parts = digests.select("digest").mapInArrow(misra_gries(counters), "digest binary, n long")
    top = (parts.groupBy("digest").agg(F.sum("n").alias("n"))
           .orderBy(F.desc("n"), "digest").limit(counters + 1).collect())
    cut = top[counters]["n"] if len(top) > counters else 0
    kept = [(r["digest"],) for r in top if r["n"] > max(cut, 1)]
    return spark.createDataFrame(kept, "digest binary")


def duplicate_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     counters: int = COUNTERS) -> DataFrame:
    """One row per document: doc_id, digest, len, keep_id, group_size, kept."""
    rows = saved(
        docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("t"))
        .select("doc_id", F.length("t").alias("len"),
                F.unhex(F.sha2(normalised(F.col("t")).cast("binary"), 256)).alias("digest"),
                F.monotonically_increasing_id().alias("rid")),
        "digests")

    def winners(part: DataFrame) -> DataFrame:
        best = F.min(F.struct((-F.col("len")).alias("neg_len"), F.col("doc_id").isNull().alias("no_id"), "doc_id", "rid"))
        return (part.groupBy("digest").agg(best.alias("best"), F.count("*").alias("group_size"))
                .select("digest", "group_size", F.col("best.doc_id").alias("keep_id"), F.col("best.rid").alias("keep_rid")))

    hot = frequent_digests(rows, counters)
    verified = saved(winners(rows.join(F.broadcast(hot), "digest", "left_semi")), "winners")
    marked = rows.join(F.broadcast(verified), "digest", "left")
    hot_rows = marked.filter("keep_rid is not null")
    rest = marked.filter("keep_rid is null").select(*rows.columns)
    cold_rows = rest.join(winners(rest), "digest")
    both = hot_rows.unionByName(cold_rows)
    return both.select("doc_id", "digest", "len", "keep_id", "group_size",
                       (F.col("rid") == F.col("keep_rid")).alias("kept"))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                counters: int = COUNTERS) -> DataFrame:
    """The kept documents, with all columns of ``docs`` as they are."""
    kept = saved(duplicate_groups(docs, id_col, text_col, counters).filter("kept")
                 .select("digest", F.col("doc_id").alias("keep_id"), F.col("len").alias("keep_len")), "kept")
    rows = packed(docs).withColumn("t", text_or_empty(F.col(f"row.{text_col}"))).select(
        "row", F.length("t").alias("len"), F.unhex(F.sha2(normalised(F.col("t")).cast("binary"), 256)).alias("digest"))
    held = rows.join(kept, (rows.digest == kept.digest) & rows.row[id_col].eqNullSafe(kept.keep_id)
                     & (rows.len == kept.keep_len), "left_semi")
    # Repeated rows (same id, same text) pass the join together; one of them stays.
    ids = docs.select(F.col(id_col).alias("i"))
    if not ids.groupBy("i").count().filter("count > 1").isEmpty():
        held = held.dropDuplicates(["digest"])
    return held.select("row.*")
