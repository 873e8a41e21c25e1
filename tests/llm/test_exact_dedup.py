import hashlib
import re
from collections import Counter

import pytest

from chronokey.llm import exact_dedup as X

from .cases import edge_documents, empty_documents


def brute(rows):
    norm = [re.sub(r"[\x20\x09-\x0D]", "", r["text"] or "") for r in rows]
    groups = {}
    for r, n in zip(rows, norm):
        groups.setdefault(n, []).append(r)
    out = Counter()
    for n, g in groups.items():
        order = sorted(g, key=lambda r: (-len(r["text"] or ""), r["doc_id"] is None, r["doc_id"] or 0))
        for i, r in enumerate(order):
            out[(r["doc_id"], order[0]["doc_id"], len(g), i == 0, hashlib.sha256(n.encode()).hexdigest())] += 1
    return out


@pytest.mark.parametrize("counters", [1, 3, 256])
def test_groups(spark, counters):
    docs = edge_documents(spark)
    got = X.duplicate_groups(docs, counters=counters).collect()
    got = Counter((r["doc_id"], r["keep_id"], r["group_size"], r["kept"], bytes(r["digest"]).hex()) for r in got)
    assert got == brute(docs.collect())


def test_kept_rows_are_whole(spark):
    docs = edge_documents(spark)
    kept = X.exact_dedup(docs)
    assert kept.columns == docs.columns
    want = Counter()
    for (i, _, _, k, h), n in brute(docs.collect()).items():
        want[(i, h)] += n * k
    got = Counter((r["doc_id"], hashlib.sha256(re.sub(r"[\x20\x09-\x0D]", "", r["text"] or "").encode()).hexdigest()) for r in kept.collect())
    assert got == +want


def test_empty(spark):
    assert X.duplicate_groups(empty_documents(spark)).count() == 0
    assert X.exact_dedup(empty_documents(spark)).count() == 0


def test_frequent_digest_is_found(spark):
    rows = [(f"{i % 97}".encode(),) for i in range(2000)] + [(b"hot",)] * 1000
    df = spark.createDataFrame(rows, "digest binary").repartition(7)
    assert b"hot" in {bytes(r[0]) for r in X.frequent_digests(df, 3).collect()}
