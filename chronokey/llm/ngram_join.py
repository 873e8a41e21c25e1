"""N-gram Jaccard join with Bayesian pruning of candidates.

Candidates are classes of equal shingle sets that share a MinHash band. Their MinHash
values are compared step by step; with a uniform prior, after m of k values agree,
the similarity is Beta(m + 1, k - m + 1). A pair is dropped once the probability that
it reaches the threshold is below TOLERANCE. What is left is verified on the exact sets.

ROWS and BANDS find a pair of similarity 0.8 with probability 1 - 3e-6.

Cases: a null text is empty. Texts without words are one class. A text of fewer than
five words has one shingle. Null ids are ordinary; a class of null ids only has a null
class_id. Repeated rows are copies. An empty table gives an empty result. Other
columns are ignored (``drop_near_copies`` returns them unchanged).
"""

from __future__ import annotations

import functools
import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import packed, saved, text_or_empty
from .near import near_classes

ROWS, BANDS = 6, 42
STEP, TOLERANCE = 28, 1e-6
THRESHOLD = (4, 5)


@functools.cache
def least_matches(n: int, step: int, tolerance: float, threshold: tuple[int, int]) -> tuple[tuple[int, int], ...]:
    """(k, m): after k values at least m must agree, else P(similarity >= threshold) < tolerance.

    P(Beta(m + 1, k - m + 1) >= t) is P(Binomial(k + 1, t) <= m).
    """
    t = threshold[0] / threshold[1]
    out = []
    for k in [*range(step, n, step), n]:
        total, m = 0.0, -1
        while total < tolerance:
            m += 1
            total += math.comb(k + 1, m) * t**m * (1 - t) ** (k + 1 - m)
        out.append((k, m))
    return tuple(out)


def bayes(left: np.ndarray, right: np.ndarray, step: int = STEP, tolerance: float = TOLERANCE,
          threshold: tuple[int, int] = THRESHOLD) -> np.ndarray:
    """Mask of the pairs (rows) that are never dropped; ``left`` may be one row."""
    alive = np.arange(len(right))
    same, at = np.zeros(len(right), np.int64), 0
    for k, m in least_matches(right.shape[1], step, tolerance, threshold):
        one = left[:, at:k] if len(left) == 1 else left[alive, at:k]
        same[alive] += (one == right[alive, at:k]).sum(axis=1)
        alive = alive[same[alive] >= m]
        at = k
    out = np.zeros(len(right), bool)
    out[alive] = True
    return out


def ngram_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, class_id, class_size, n_copies, n_links (other shingle sets that are alike to its own)."""
    return near_classes(docs, ROWS, BANDS, bayes, id_col, text_col, *THRESHOLD).drop("th", "first")


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each class: the one with the smallest id (nulls last; of repeated rows, one)."""
    first = saved(near_classes(docs, ROWS, BANDS, bayes, id_col, text_col, *THRESHOLD).filter("first").select("doc_id", "th"), "first")
    rows = packed(docs)
    rows = rows.withColumn("th", F.md5(text_or_empty(F.col(f"row.{text_col}")).cast("binary"))).withColumn("i", F.col(f"row.{id_col}"))
    kept = first.select(F.col("doc_id").alias("k"), F.col("th").alias("kept_th")).distinct()
    out = rows.join(kept, rows.i.eqNullSafe(kept.k) & (rows.th == kept.kept_th), "left_semi")
    if not first.groupBy("doc_id", "th").count().filter("count > 1").isEmpty():
        out = out.dropDuplicates(["i", "th"])
    return out.select("row.*")
