"""Document fingerprints: MinHash signatures of each text and of an edited text.

The edited text has the last quarter of the code points replaced by the first as
many of the next document in ascending id order (the first one follows the last).
Documents are dealt into contiguous id ranges, compressed; the first document of each
range is also sent to the range before it, so every task sees its documents'
successors, and no task sees all documents.

``fingerprint_groups`` joins signature bands in Spark and verifies the Jaccard
similarity of candidates (five words, 0.8 or more) on the exact shingle sets. ROWS and BANDS
find a pair of similarity 0.8 with probability 0.9998.

Cases: a null text is empty, has an all-zero fingerprint, and is like another empty text.
Null ids come last; rows of equal ids are ordered by a hash of their text. A single
document follows itself. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import shingles
from .common import text_or_empty
from .near import near_classes

ROWS, BANDS = 4, 16
PERMUTATIONS = ROWS * BANDS


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of equal MinHash values, by row."""
    return (a == b).mean(axis=1)


def edited(text: str, following: str) -> str:
    quarter = len(text) // 4
    return text[:len(text) - quarter] + following[:quarter]


def id_ranges(ids: DataFrame, n: int) -> tuple[list[int], list[tuple[int, int | None]]]:
    """At most n - 1 bounds that cut the ids into ranges, and (range, its first id or None) of the ranges in use."""
    at = [i / n for i in range(1, n)]
    found = ids.select(F.percentile_approx("doc_id", at, F.lit(20_000)).alias("q")).first()["q"] if at else []
    bounds = sorted(set(found or []))

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        least: dict[int, int | None] = {}
        for b in batches:
            for k in b.column(0).to_pylist():
                r = range_of(bounds, k)
                if r not in least or k is not None and k < least[r]:
                    least[r] = k
        yield pa.RecordBatch.from_arrays([pa.array(list(least), pa.int32()), pa.array(list(least.values()), pa.int64())], ["r", "k"])

    firsts = ids.select("doc_id").mapInArrow(run, "r int, k long").groupBy("r").agg(F.min("k").alias("k")).collect()
    return bounds, sorted((r["r"], r["k"]) for r in firsts)


def range_of(bounds: list[int], key: int | None) -> int:
    """Range 0 ends before the first bound; null ids have the range after all others."""
    from bisect import bisect_right

    return len(bounds) + 1 if key is None else bisect_right(bounds, key)


def with_successors(texts: DataFrame, n: int) -> DataFrame:
    """(r, doc_id, th, tail, z), sorted inside partitions: ranges of documents, each closed by the first of the next."""
    bounds, firsts = id_ranges(texts.select("doc_id"), n)
    order = [r for r, _ in firsts]
    before = {first: (order[i - 1], i == 0) for i, (_, first) in enumerate(firsts)}

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        import xxhash
        import zstandard

        press = zstandard.ZstdCompressor(level=3)
        for b in batches:
            out = []
            for k, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                raw = t.encode()
                z, th = press.compress(raw), xxhash.xxh3_128_digest(raw)
                out.append((range_of(bounds, k), k, th, False, z))
                if k in before:
                    out.append((before[k][0], k, th, True, z))
            kinds = (pa.int32(), pa.int64(), pa.binary(), pa.bool_(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(list(c), x) for c, x in zip(zip(*out, strict=True), kinds, strict=True)]
                                             if out else [pa.array([], x) for x in kinds], ["r", "doc_id", "th", "tail", "z"])

    rows = texts.select("doc_id", "t").mapInArrow(run, "r int, doc_id long, th binary, tail boolean, z binary")
    return rows.repartition(n, "r").sortWithinPartitions("r", "tail", F.col("doc_id").asc_nulls_last(), "th")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", permutations: int = PERMUTATIONS,
                 partitions: int | None = None) -> DataFrame:
    """doc_id, th, n_chars, edited_sha256, sig, edited_sig (16-bit MinHash values), near_edited, near_next."""
    n = partitions or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("t"))
    rows = with_successors(texts, n)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        import zstandard

        unpack = zstandard.ZstdDecompressor().decompress
        names = ["doc_id", "th", "n_chars", "edited_sha256", "sig", "edited_sig", "near_edited", "near_next"]

        def result(run_: list) -> pa.RecordBatch:
            """``run_``: consecutive documents, the last of which only follows."""
            texts = [t for _, _, t in run_]
            new = [edited(a, b) for a, b in zip(texts, texts[1:], strict=False)]
            sets = shingles.shingle_sets(texts + new)
            sig = shingles.signatures(sets, permutations)
            own, following, changed = sig[:len(new)], sig[1:len(texts)], sig[len(texts):]
            return pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in run_[:-1]], pa.int64()), pa.array([r[1] for r in run_[:-1]], pa.binary()),
                 pa.array([len(t) for t in texts[:-1]], pa.int64()),
                 pa.array([hashlib.sha256(t.encode()).hexdigest() for t in new], pa.string()),
                 pa.array([x.tobytes() for x in own], pa.binary()), pa.array([x.tobytes() for x in changed], pa.binary()),
                 pa.array(likeness(own, changed)), pa.array(likeness(own, following))], names)

        held: list = []
        current, closed = None, True
        for batch in batches:
            r, ids, th, tail, z = (c.to_pylist() for c in batch.columns)
            for k in range(batch.num_rows):
                if r[k] != current:
                    if not closed:
                        raise ValueError("a range without a successor")
                    held, current, closed = [], r[k], False
                if closed:
                    continue  # more rows that share the successor's id
                held.append((ids[k], th[k], unpack(z[k]).decode()))
                closed = tail[k]
                if len(held) > 256 or closed:
                    yield result(held)
                    held = held[-1:]

    return rows.mapInArrow(run, "doc_id long, th binary, n_chars long, edited_sha256 string, sig binary, edited_sig binary, "
                                "near_edited double, near_next double")


def banded(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Pairs that share a band are all verified."""
    return np.broadcast_to(left.reshape(len(left), BANDS, ROWS) == right.reshape(len(right), BANDS, ROWS),
                           (len(right), BANDS, ROWS)).all(axis=2).any(axis=1)


def fingerprint_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, th (MD5 of the text), class_id, class_size, n_copies, n_links of the verified band join."""
    return near_classes(docs, ROWS, BANDS, banded, id_col, text_col).drop("first")
