import random

import numpy as np
import pytest

from chronokey.llm import fingerprints as P
from chronokey.llm import ngram_join as N
from chronokey.llm import shingles as S
from chronokey.llm.common import documents
from chronokey.llm.components import components

from .cases import edge_documents, empty_documents


def shingle_set(text):
    w = [x for x in __import__("re").findall(r"[^\x20\x09-\x0D]+", text)]
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def brute_classes(rows):
    """Smallest id of the connected component of all pairs with Jaccard >= 0.8, by position in rows."""
    sets = [shingle_set(r["text"] or "") for r in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            common = len(a & sets[j])
            if common * 5 >= 4 * (len(a) + len(sets[j]) - common):
                root[max(find(i), find(j))] = min(find(i), find(j))
    groups = {}
    for i in range(len(rows)):
        groups.setdefault(find(i), []).append(rows[i]["doc_id"])
    return [min((d for d in groups[find(i)] if d is not None), default=None) for i in range(len(rows))]


def noisy(spark):
    """Bases with copies of many degrees of change, and a group that all shares one base."""
    rng = random.Random(11)
    word = lambda: "".join(rng.choices("abcdefgh", k=rng.randint(2, 7)))
    texts = []
    for size, n in ((60, 40), (200, 8), (90, 8), (400, 4)):
        base = [word() for _ in range(size)]
        for _ in range(n):
            w = list(base)
            for _ in range(rng.choice([0, 1, 1, 2, 3, 8])):
                w[rng.randrange(len(w))] = word()
            texts.append(" ".join(w))
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


@pytest.mark.parametrize("table", ["edge", "noisy", "sf0.001"])
def test_classes_equal_all_pairs(spark, table):
    docs = edge_documents(spark) if table == "edge" else noisy(spark) if table == "noisy" else documents(spark, "/root/testdata/sf0.001")
    rows = docs.select("doc_id", "text").collect()
    want = sorted(zip((r["doc_id"] for r in rows), brute_classes(rows)), key=str)
    got = N.ngram_classes(docs).collect()
    assert sorted(((r["doc_id"], r["class_id"]) for r in got), key=str) == want
    kept = N.drop_near_copies(docs)
    assert kept.columns == docs.columns
    n_classes = len({(c, ) if c is not None else (None, i) for i, (_, c) in enumerate(want)})
    assert kept.count() <= n_classes
    assert {r["doc_id"] for r in kept.collect()} >= {c for _, c in want if c is not None}


@pytest.mark.parametrize("block", [256, 7])
def test_links_equal_all_pairs(spark, monkeypatch, block):
    from chronokey.llm import near

    monkeypatch.setattr(near, "COUNT_BLOCK", block)
    docs = noisy(spark).union(edge_documents(spark).select("doc_id", "text"))
    rows = docs.collect()
    sets = {s for r in rows if (s := shingle_set(r["text"] or ""))}
    alike = lambda a, b: len(a & b) * 5 >= 4 * len(a | b)
    want = [(r["doc_id"], sum(alike(s, o) for o in sets if o != s) if (s := shingle_set(r["text"] or "")) else 0) for r in rows]
    got = [(r["doc_id"], r["n_links"]) for r in N.ngram_classes(docs).collect()]
    assert sorted(got, key=str) == sorted(want, key=str) and max(n for _, n in want) > 2


def test_blocks_find_links_between_members(spark, monkeypatch):
    """Without any star found, the comparison inside buckets finds enough links."""
    from chronokey.llm import near

    monkeypatch.setattr(near, "BLOCK", 4)
    docs = noisy(spark)
    rows = docs.collect()
    texts = docs.withColumnRenamed("text", "t")
    seen = near.verified
    calls = []

    def without_stars(pairs, bodies, a, b):
        out = seen(pairs, bodies, a, b)
        calls.append(1)
        return out.filter("false") if len(calls) == 1 else out

    monkeypatch.setattr(near, "verified", without_stars)
    _, links, groups = near.near_links(texts, N.ROWS, N.BANDS, N.bayes)
    assert len(calls) == 1 and links.count() > 20 and len(rows) == 60
    got = {r["cid"]: r["component"] for r in groups.collect()}
    assert {r["id"]: r["component"] for r in components(links).collect()} == got
    # Buckets of two aren't compared again (their one pair is a star), so classes may only be finer than all pairs'.
    by_text = {}
    for r, c in zip(rows, brute_classes(rows)):
        by_text.setdefault(r["text"], c)
    assert len(set(got.values())) >= 4 and len(rows) == 60 and len(by_text) >= len(got)


def test_bayes_keeps_alike_pairs():
    rng = np.random.default_rng(1)
    n = N.ROWS * N.BANDS
    base = rng.integers(0, 1 << 16, (2000, n)).astype(np.uint16)
    for j, least in ((0.8, 1999), (0.9, 2000)):
        other = np.where(rng.random(base.shape) < j, base, base + 1)
        assert N.bayes(base, other).sum() >= least
    other = np.where(rng.random(base.shape) < 0.5, base, base + 1)
    assert N.bayes(base, other).sum() == 0
    assert (N.bayes(base[:1], base) == (base == base[0]).all(axis=1)).all()


def test_signatures_estimate_jaccard():
    rng = random.Random(2)
    words = ["".join(rng.choices("abcdef", k=5)) for _ in range(600)]
    a, b = " ".join(words[:450]), " ".join(words[50:500])
    sets = S.shingle_sets([a, b, "", "one two"])
    true = len(np.intersect1d(sets[0], sets[1])) / len(np.union1d(sets[0], sets[1]))
    sig = S.signatures(sets, 512)
    assert abs((sig[0] == sig[1]).mean() - true) < 0.08
    assert len(sets[0]) == len(shingle_set(a)) and len(sets[2]) == 0 and len(sets[3]) == 1 and not sig[2].any()


def test_components(spark):
    rng = random.Random(6)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 100 + i) for i in range(1, 40)] + [(rng.randrange(200, 260), rng.randrange(200, 260)) for _ in range(25)]
    got = {r["id"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    root = {x: x for e in edges for x in e}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    assert got == {x: find(x) for e in edges if e[0] != e[1] for x in e}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("table", ["edge", "sf0.001"])
@pytest.mark.parametrize("partitions", [1, 7])
def test_fingerprints_of_edited_texts(spark, table, partitions):
    import hashlib

    import xxhash

    docs = edge_documents(spark) if table == "edge" else documents(spark, "/root/testdata/sf0.001")
    rows = [(r[0], r[1] or "") for r in docs.select("doc_id", "text").collect()]
    rows.sort(key=lambda r: (r[0] is None, r[0] or 0, xxhash.xxh3_128_digest(r[1].encode())))
    want = []
    for i, (k, t) in enumerate(rows):
        q = len(t) // 4
        want.append((k, len(t), hashlib.sha256((t[:len(t) - q] + rows[(i + 1) % len(rows)][1][:q]).encode()).hexdigest()))
    got = P.fingerprints(docs, partitions=partitions).collect()
    assert sorted(((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in got), key=str) == sorted(want, key=str)
    assert all(0 <= r[c] <= 1 for r in got for c in ("near_edited", "near_next"))
    by_text = {}
    for r in got:
        assert by_text.setdefault(bytes(r["th"]), bytes(r["sig"])) == bytes(r["sig"])


def test_fingerprint_groups(spark):
    docs = noisy(spark)
    rows = docs.collect()
    got = {r["doc_id"]: r["class_id"] for r in P.fingerprint_groups(docs).collect()}
    assert sum(got[r["doc_id"]] != c for r, c in zip(rows, brute_classes(rows))) == 0


def test_empty_tables(spark):
    docs = empty_documents(spark)
    assert N.ngram_classes(docs).count() == 0 and N.drop_near_copies(docs).count() == 0
    assert P.fingerprints(docs).count() == 0 and P.fingerprint_groups(docs).count() == 0


def test_components_of_large_ids(spark):
    """Ids take all 64 bits, as those of late partitions of a wide table do: nothing overflows."""
    top, n = 2**62, 3000
    edges = [(top + i, top + i + 1) for i in range(0, n, 2)] + [(top + i, top + i + 2) for i in range(0, n // 2, 2)] + [(-top, top)]
    got = {r["id"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    assert got == {x: find(x) for x in list(root)}
