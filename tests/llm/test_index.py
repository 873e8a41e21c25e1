"""Decontamination, the Merkle manifest and ranked search against brute force, and on edge cases."""

import hashlib
import math
import random
import re
import zlib

import pytest


from chronokey.llm import decontamination, merkle, ranking

from .cases import edge_documents, empty_documents

WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {u: u + 32 for u in range(65, 91)}
ITEMS = "item_id string, text string, len string, at string, sh string, key string, ws string"


def ws(text):
    return WORD.findall((text or "").translate(LOWER))


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def items_of(spark, rows):
    """Items with further columns whose names clash with helper columns."""
    return spark.createDataFrame([(*r, "x", "x", "x", "x", "x") for r in rows], ITEMS)


def edge_items(spark):
    docs = edge_documents(spark).collect()
    long = next(r["text"] for r in docs if r["text"] and len(r["text"]) > 50_000).split()
    prose = [r["text"].split() for r in docs if r["text"] and 500 < len(r["text"]) < 50_000]
    return items_of(spark, [
        ("none", None), ("none2", ""), ("none3", " .,\n"), ("one", "A"), ("two", "a a"), (None, "x's"),
        ("in long", " ".join(long[100:140])), ("end", " ".join(long[-12:])), ("begin", " ".join(long[:10])),
        ("cut", " ".join([*prose[0][3:12], "zzz", *prose[0][12:15]])), ("two docs", " ".join([*prose[1][:14], *prose[2][4:20]])),
        ("again", " ".join(prose[1][:14])), ("again", " ".join(prose[3][2:19])), ("Case", " ".join(prose[4][5:18]).upper()), ("nine", " ".join(prose[5][:9])),
        ("licence", "released under the mit license, LICENSED under the apache license version"), ("gone", "no such words stand in any text of these at all")])


def hits_of(text, items, window=10):
    """(words, hit words, sorted ids) by comparing every window at every place."""
    w, hit, ids = ws(text), set(), set()
    for item, its in items:
        iw = ws(its)
        k = min(window, len(iw))
        for p in range(len(iw) - k + 1) if k else ():
            for s in range(len(w) - k + 1):
                if w[s] == iw[p] and w[s : s + k] == iw[p : p + k]:
                    hit |= {*range(s, s + k)}
                    ids.add(item or "")
    return len(w), len(hit), sorted(ids)


def rows_of(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


def test_contamination_edges(spark):
    docs, items = edge_documents(spark), edge_items(spark)
    got = decontamination.contamination(docs, items)
    pairs = [(r["item_id"], r["text"]) for r in items.collect()]
    want = []
    for r in docs.collect():
        n, hit, ids = hits_of(r["text"], pairs)
        want.append((r["doc_id"], n, hit, len(ids), sha(",".join(ids)), hit > 0, ids))
    assert rows_of(got, "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "item_ids") == sorted(want, key=repr)
    assert sum(w[5] for w in want) >= 8


def test_contamination_letters_beyond_ascii(spark):
    """Only A-Z are lower-cased; letters whose lower case depends on their neighbours or is longer lose nothing."""
    body = "ΑΣ'Α İstanbul ΟΔΟΣ K ÉTÉ Straße ONE two Σ end"
    docs = spark.createDataFrame([(1, f"so {body}. then"), (2, f"so {body.lower()}"), (3, body.replace("ONE", "one"))], "doc_id long, text string")
    items = spark.createDataFrame([("greek", body.replace("two", "TWO"))], "item_id string, text string")
    got = {r["doc_id"]: r["n_hit"] for r in decontamination.contamination(docs, items).collect()}
    assert got == {r["doc_id"]: hits_of(r["text"], [("greek", body)])[1] for r in docs.collect()}
    assert got[1] > 0 and got[2] == 0 and got[3] > 0


def test_contamination_empty(spark):
    docs, items = edge_documents(spark), edge_items(spark)
    assert decontamination.contamination(empty_documents(spark), items).count() == 0
    got = decontamination.contamination(docs, items.limit(0))
    assert got.count() == docs.count() and got.filter("contaminated or n_items > 0").isEmpty()


def tree(nodes):
    """(root, for each node the siblings left and right on its way)."""
    ways, at, now = [[] for _ in nodes], list(range(len(nodes))), nodes
    while len(now) > 1:
        for i, p in enumerate(at):
            run = range(p // 3 * 3, min(p // 3 * 3 + 3, len(now)))
            ways[i].append(([now[j] for j in run if j < p], [now[j] for j in run if j > p]))
        at = [p // 3 for p in at]
        now = [sha("".join(now[i : i + 3])) for i in range(0, len(now), 3)]
    return now[0], ways


def leaf_of(r):
    return sha("".join("-" if r[c] is None else f"{len(str(r[c]).encode())}:{r[c]}" for c in ("doc_id", "source", "lang", "n_chars", "text")))


def manifest_of(rows):
    by = {}
    for r in rows:
        by.setdefault(r["source"], []).append(r)
    names = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    for s in names:
        by[s].sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf_of(r)))
    trees = [tree([leaf_of(r) for r in by[s]]) for s in names]
    root, above = tree([t[0] for t in trees])
    out = []
    for s, (subroot, ways), up in zip(names, trees, above):
        for r, way in zip(by[s], ways):
            path, d = way + up, r.asDict()
            if r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 2 == 0 and r["text"] is not None:
                d["text"] = r["text"].replace("\n", "")
            h = leaf_of(d)
            for a, b in path:
                h = sha("".join([*a, h, *b]))
            out.append((r["doc_id"], leaf_of(r), subroot, root, sha("".join(x for a, b in path for x in a + b)), h, h == root))
    return sorted(out, key=repr)


MANIFEST = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def test_manifest_edges(spark):
    docs = edge_documents(spark)
    assert rows_of(merkle.manifest(docs), *MANIFEST) == manifest_of(docs.collect())
    assert merkle.manifest(empty_documents(spark)).count() == 0


@pytest.mark.parametrize("depth", [1, 2])
def test_manifest_many_rounds(spark, monkeypatch, depth):
    """Blocks of 3 and 9 nodes and short sorted runs: sources of every size up to several rounds."""
    monkeypatch.setattr(merkle.forest, "__defaults__", (depth,))
    monkeypatch.setattr(merkle, "SORT_ROWS", 20)
    rng = random.Random(depth)
    rows = [(rng.randrange(500), f"a\nb{i}" if i % 3 else None, None, src, i) for src, n in
            [(None, 1), ("a", 2), ("b", 3), ("c", 4), ("é", 9), ("Z", 10), ("zz", 28), ("", 83)] for i in range(n)]
    rows += rows[-3:]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert rows_of(merkle.manifest(docs), *MANIFEST) == manifest_of(docs.collect())


def ranking_of(docs, items, top=10):
    words = [(d, ws(t)) for d, t in docs]
    words = [(d, w) for d, w in words if w]
    n_docs, length = len(words), sum(len(w) for _, w in words)
    df = {}
    for _, w in words:
        for t in set(w):
            df[t] = df.get(t, 0) + 1
    out = []
    for item, text in items:
        scored = []
        for d, w in words:
            m = 25 + (75 * len(w) * n_docs) // length
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * w.count(t)) // (1000 * w.count(t) + 8 * m))
                        for t in ws(text) if t in df)
            if score > 0:
                scored.append((-score, d is None, d or 0))
        out += [(item, k, None if null else d, -s) for k, (s, null, d) in enumerate(sorted(scored)[:top], 1)]
    return sorted(out, key=repr)


RANKED = ("item_id", "rank", "doc_id", "score")


@pytest.mark.parametrize("block_terms, group_postings, words", [(200_000, 2_000_000, 300_000), (40, 3, 5)])
def test_search_edges(spark, monkeypatch, block_terms, group_postings, words):
    """Also with many blocks of items and groups of few postings, and with sums in integers."""
    monkeypatch.setattr(ranking, "EXACT_WORDS", words)
    docs, items = edge_documents(spark), edge_items(spark)
    got = ranking.search(docs, items, block_terms=block_terms, group_postings=group_postings)
    small = [(r["item_id"], r["text"]) for r in items.collect()]
    assert rows_of(got, *RANKED) == ranking_of([(r["doc_id"], r["text"]) for r in docs.collect()], small)
    assert got.schema["rank"].dataType.simpleString() == "int"


def test_search_empty(spark):
    docs, items = edge_documents(spark), edge_items(spark)
    assert ranking.search(empty_documents(spark), items).count() == 0
    assert ranking.search(docs, items.limit(0)).count() == 0


def test_strata_bounds_are_exact():
    """Strata of random postings: the search by falling bounds equals scoring all of them."""
    np = pytest.importorskip("numpy")
    rng = np.random.default_rng(3)
    weights = rng.integers(0, 9, 40)
    strata, every = [], []
    for m in (25, 26, 40, 90, 400):
        ids = np.sort(rng.choice(10_000, 30, replace=False))
        tf = rng.integers(0, 4, (30, 40)) * rng.integers(0, 2, (30, 40))
        owner, term = np.nonzero(tf)
        strata.append(ranking.Stratum(m, ranking._DocIds(ids, np.zeros(30, bool)), term, tf[owner, term], owner, weights))
        every.append((m, ids, tf))
    items = [(k, np.sort(rng.choice(40, 12, replace=False)), rng.integers(1, 3, 12)) for k in range(20)]
    got = list(ranking.search_strata(strata, items))
    want = []
    for key, t, q in items:
        scored = [(-int(sum(qq * weights[x] * (10**9 * int(row[x]) // (1000 * int(row[x]) + 8 * m)) for x, qq in zip(t, q))), int(i))
                  for m, ids, tf in every for i, row in zip(ids, tf)]
        want += [(key, -s, i) for s, i in sorted(x for x in scored if x[0] < 0)[:10]]
    assert got == want
