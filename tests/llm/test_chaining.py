import random

import numpy as np
import pytest

from chronokey.llm import chaining as H
from chronokey.llm import shingles
from chronokey.llm.common import documents

from .cases import edge_documents, empty_documents


def brute_chain(x, y, k, cost):
    """Best score of a chain by all pairs."""
    order = sorted(range(len(x)), key=lambda i: (x[i], y[i]))
    score = {}
    for i in order:
        gain = max((score[j] - cost * (x[i] - x[j] + y[i] - y[j]) + min(k, x[i] - x[j], y[i] - y[j]) - k
                    for j in order if j in score and x[j] < x[i] and y[j] < y[i]), default=0)
        score[i] = k + max(0, gain)
    return max(score.values())


def test_fenwick_chains():
    rng = random.Random(1)
    for _ in range(200):
        n = rng.randint(1, 40)
        points = list({(rng.randrange(60), rng.randrange(60)) for _ in range(n)})
        x, y = (np.array(c) for c in zip(*points))
        chains = H.chain(x, y)
        assert sorted(i for c in chains for i in c) == list(range(len(x)))
        for c in chains:
            assert all(x[a] < x[b] and y[a] < y[b] for a, b in zip(c, c[1:]))
        best = chains[0]
        total = H.K
        for a, b in zip(best, best[1:]):
            dx, dy = x[b] - x[a], y[b] - y[a]
            total += min(H.K, dx, dy) - H.GAP_COST * (dx + dy)
        # Overlaps count less than K, which the tree's order can't see: chains may differ by that much a step.
        assert total >= brute_chain(x.tolist(), y.tolist(), H.K, H.GAP_COST) - H.K * len(best) / 2


def test_minimizers_of_shared_stretches():
    rng = random.Random(2)
    word = lambda: "".join(rng.choices("abcdef", k=5))
    for _ in range(50):
        shared = [word() for _ in range(H.K + H.WINDOW - 1)]
        texts = [" ".join([word() for _ in range(rng.randint(0, 30))] + shared + [word() for _ in range(rng.randint(0, 30))]) for _ in range(2)]
        text, _, h = H.minimizers(texts)
        assert set(h[text == 0]) & set(h[text == 1])
    assert len(H.minimizers(["", "a b"])[0]) == 0


def planted(spark, size=55, n=60, edits=0):
    """Documents of random words; every third carries one of four passages at a random place, with edits."""
    rng = random.Random(size + edits)
    word = lambda: "".join(rng.choices("abcdefghij", k=rng.randint(2, 7)))
    passages = [[word() for _ in range(size)] for _ in range(4)]
    rows, carriers = [], {}
    for i in range(n):
        w = [word() for _ in range(rng.randint(80, 300))]
        if i % 3 == 0:
            p = list(passages[i % 4])
            for k in range(edits):
                p[(k + 1) * size // (edits + 1)] = word()
            at = rng.randrange(len(w))
            w[at:at] = p
            carriers.setdefault(i % 4, []).append(i)
        rows.append((i, " ".join(w)))
    return spark.createDataFrame(rows, "doc_id long, text string"), carriers


@pytest.mark.parametrize(("size", "edits"), [(52, 0), (80, 2), (120, 4)])
def test_planted_passages(spark, size, edits):
    docs, carriers = planted(spark, size=size, edits=edits)
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    rows = H.repeated_passages(docs).collect()
    for ids in carriers.values():
        seen = {r["doc_id"] for r in rows} | {r["other_id"] for r in rows}
        assert set(ids) <= seen
    allowed = {frozenset((a, b)) for ids in carriers.values() for a in ids for b in ids}
    for r in rows:
        assert frozenset((r["doc_id"], r["other_id"])) in allowed and r["doc_id"] > r["other_id"]
        own = texts[r["doc_id"]][r["start"]:r["end"]].split()
        other = texts[r["other_id"]][r["other_start"]:r["other_end"]].split()
        assert len(own) == r["end_word"] - r["start_word"] >= 45 and len(other) == r["other_end_word"] - r["other_start_word"]
        if not edits:
            assert own == other and r["identity"] == 1.0 and len(own) >= size
        assert r["identity"] > 0.7


def words_by(rng, n):
    return ["".join(rng.choices("abcdefghij", k=rng.randint(3, 8))) for _ in range(n)]


def covered(rows, doc, other):
    """Words of ``doc`` (start to end) in passages shared with ``other``, either way round."""
    out = set()
    for r in rows:
        if (r["doc_id"], r["other_id"]) == (doc, other):
            out |= set(range(r["start_word"], r["end_word"]))
        if (r["other_id"], r["doc_id"]) == (doc, other):
            out |= set(range(r["other_start_word"], r["other_end_word"]))
    return out


@pytest.mark.parametrize(("first", "gap"), [(60, 10), (60, 20), (14, 15)])
def test_every_passage_of_a_chain(spark, first, gap):
    """Two passages some different words apart, and a stock phrase before a passage."""
    rng = random.Random(first + gap)
    rows = []
    for i in range(12):
        one, two = words_by(rng, first), words_by(rng, 60)
        for j in range(2):
            rows.append((2 * i + j, " ".join([*words_by(rng, 50), *one, *words_by(rng, gap), *two, *words_by(rng, 50)])))
    got = H.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    for i in range(12):
        here = covered(got, 2 * i, 2 * i + 1)
        assert set(range(50 + first + gap, 110 + first + gap)) <= here
        assert first < 45 or set(range(50, 50 + first)) <= here


def test_removal_of_spans_leaves_one_copy(spark):
    rng = random.Random(8)
    passages = [words_by(rng, 80) for _ in range(3)]
    texts = {}
    for i in range(30):
        texts[i] = [*words_by(rng, rng.randint(20, 60)), *passages[i % 3], *words_by(rng, rng.randint(20, 60))]
    rows = [(i, " ".join(w)) for i, w in texts.items()] + [(40, " ".join(texts[9])), (None, " ".join([*words_by(rng, 30), *passages[0]]))]
    texts |= {40: texts[9], None: rows[-1][1].split()}
    gone = {i: set() for i in texts}
    for r in H.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        gone[r["doc_id"]] |= set(range(r["start_word"], r["end_word"]))
    left = {i: [w for k, w in enumerate(ws) if k not in gone[i]] for i, ws in texts.items()}
    for j, p in enumerate(passages):
        assert [i for i, ws in left.items() if len(set(p) & set(ws)) > 10] == [j]
        assert left[j] == texts[j]


def test_documents_with_a_run_of_fifty_words_are_found(spark):
    docs = documents(spark, "/root/testdata/sf0.001")
    where = {}
    for r in docs.collect():
        w = r["text"].split()
        for k in range(len(w) - 49):
            where.setdefault(tuple(w[k:k + 50]), set()).add(r["doc_id"])
    want = {i for ids in where.values() if len(ids) > 1 for i in ids}
    rows = H.repeated_passages(docs).collect()
    assert want and want <= {r["doc_id"] for r in rows} | {r["other_id"] for r in rows}


def test_edges(spark):
    rows = H.repeated_passages(edge_documents(spark)).collect()
    copies = [r for r in rows if r["doc_id"] is None]
    assert len(copies) == 1 and all(r["other_id"] is not None for r in rows)
    assert any(r["doc_id"] == 8 and r["other_id"] == 7 and r["n_words"] == 20_000 for r in rows)
    assert H.repeated_passages(empty_documents(spark)).count() == 0


def test_recall_of_edited_passages():
    """A word altered each 10 or 15 words: at least 0.9 of the passages are found, by 80 % of their words."""
    rng = random.Random(31)

    def some(n):
        return ["".join(rng.choices("abcdefghijklmnop", k=5)) for _ in range(n)]

    for words, every in ((60, 15), (60, 10), (80, 10), (120, 10)):
        hit = 0
        for _ in range(100):
            own = some(words)
            other = [f"x{w}" if i % every == every - 1 else w for i, w in enumerate(own)]
            texts = [" ".join(some(80) + own + some(80)), " ".join(some(60) + other + some(90))]
            text, place, h = H.minimizers(texts)
            first = dict(zip(h[text == 0].tolist(), place[text == 0].tolist()))
            links = [(first[k], p) for k, p in zip(h[text == 1].tolist(), place[text == 1].tolist()) if k in first]
            if not links:
                continue
            x, y = (np.array(v) for v in zip(*links))
            a, b = (shingles.word_hashes([t])[0] for t in texts)
            hit += any(min(e, 80 + words) - max(s, 80) >= 0.8 * words for s, e, _, _, _ in H.align(a, b, H.stretches(x, y)))
        assert hit >= 90, (words, every, hit)


@pytest.mark.parametrize("block", [H.BLOCK, 8])
def test_passage_whose_halves_other_texts_hold(spark, monkeypatch, block):
    """Texts 4 to 7 share 64 words, of which 0 and 2 hold the first half, 1 and 3 the second one."""
    monkeypatch.setattr(H, "BLOCK", block)
    rng = random.Random(12)
    rows = []
    for i in range(20):
        words = words_by(rng, 64)
        parts = [words[:32], words[32:]] * 2 + [words] * 4
        rows += [(8 * i + j, " ".join([*words_by(rng, 40), *p, *words_by(rng, 40)])) for j, p in enumerate(parts)]
    got = H.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert all(r["doc_id"] > r["other_id"] for r in got)
    for i in range(20):
        linked, more = {8 * i + 4}, True
        while more:
            more = {r[b] for r in got for a, b in (("doc_id", "other_id"), ("other_id", "doc_id")) if r[a] in linked} - linked
            linked |= more
        assert linked >= {8 * i + j for j in range(4, 8)}
        for j in range(5, 8):
            assert set(range(40, 104)) <= set().union(*(covered(got, 8 * i + j, 8 * i + k) for k in range(4, 8)))


def test_each_pair_without_a_common_partner(spark):
    """Six texts share 28 words; each two of them share 24 other words behind these, too, that no third one has."""
    rng = random.Random(13)
    rows, want = [], set()
    for i in range(6):
        common = words_by(rng, 28)
        ids = list(range(10 * i, 10 * i + 6))
        texts = {j: words_by(rng, 30) for j in ids}
        for a in ids:
            for b in ids:
                if a < b:
                    own = words_by(rng, 24)
                    want.add((b, a))
                    for j in (a, b):
                        texts[j] += [*common, *own, *words_by(rng, 50)]
        rows += [(j, " ".join(w)) for j, w in texts.items()]
    got = H.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r["doc_id"], r["other_id"]) for r in got} == want
    assert all(r["n_words"] >= 52 for r in got)


def test_passage_behind_an_earlier_place_of_its_words(spark):
    """The text with the smaller id has part of the passage twice, the whole one later."""
    rng = random.Random(14)
    rows = []
    for i in range(12):
        words = words_by(rng, 60)
        rows += [(2 * i, " ".join([*words[:30], *words_by(rng, 20), *words[30:], *words_by(rng, 50), *words])), (2 * i + 1, " ".join([*words_by(rng, 40), *words, *words_by(rng, 40)]))]
    got = H.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    for i in range(12):
        assert set(range(40, 100)) <= covered(got, 2 * i + 1, 2 * i)


def test_comparison_loses_no_passage():
    """Wherever the alignment from a place finds a passage, the comparison of the words around it lets it through."""
    rng = random.Random(15)
    own, other, long = [], [], []
    for _ in range(400):
        a = [rng.randrange(250) for _ in range(120)]
        b = list(a)
        for _ in range(rng.choice([0, 4, 8, 16])):
            k = rng.randrange(len(b))
            b[k:k + rng.randrange(4)] = [rng.randrange(250) for _ in range(rng.randrange(4))]
        a, b = np.array(a), np.array(b)
        for x in range(0, 115, 5):
            y = next((y for y in range(max(0, x - 9), min(len(b) - H.K, x + 9) + 1) if (a[x:x + H.K] == b[y:y + H.K]).all()), None)
            if y is not None:
                left, right = H.walk(a[:x][::-1], b[:y][::-1]), H.walk(a[x:], b[y:])
                long.append(min(left[0] + right[0], left[1] + right[1]) >= H.MIN_WORDS)
                for out, words, at in ((own, a, x), (other, b, y)):
                    pad = np.full(H.MIN_WORDS, H.PAD)
                    out.append(np.concatenate([pad, words, pad])[at:at + 2 * H.MIN_WORDS].astype(np.uint8))
    near, n = np.array(own + other), len(own)
    passes = H.may_pass(near[:, :H.MIN_WORDS][:, ::-1], near[:, H.MIN_WORDS:], np.arange(n), n + np.arange(n))
    assert 100 < sum(long) < n and passes[np.array(long)].all()
    strangers = H.may_pass(near[:, :H.MIN_WORDS][:, ::-1], near[:, H.MIN_WORDS:], np.arange(n), np.roll(np.arange(n), n // 2))
    assert strangers.mean() < 0.05


def edited(rng, words, edits):
    out = list(words)
    for _ in range(edits):
        k = rng.randrange(len(out) + 1)
        out[k:k + rng.randrange(3)] = [rng.randrange(5000) for _ in range(rng.randrange(3))]
    return out


def near_words(texts, at=60):
    pad = [H.BLANK] * H.NEAR
    rows = np.array([(pad + list(t) + pad)[at:at + 2 * H.NEAR] for t in texts]).astype(np.uint16)
    return rows[:, :H.NEAR][:, ::-1], rows[:, H.NEAR:]


def test_walks_agree_with_walk():
    rng = random.Random(16)
    pairs = []
    for _ in range(400):
        a = [rng.randrange(rng.choice([5, 40, 5000])) for _ in range(rng.randrange(80))]
        pairs.append((a, edited(rng, a, rng.randrange(8))))
    sides = [np.array([(t + [H.BLANK] * H.NEAR)[:H.NEAR] for t in texts]).astype(np.uint16) for texts in zip(*pairs)]
    got = list(zip(*(v.tolist() for v in H.walks(*sides))))
    assert 50 < sum(cut for _, _, cut in got) < 350
    for (a, b), (x, y, cut) in zip(pairs, got):
        want = H.walk(np.array(a, int), np.array(b, int))[:2]
        assert (x, y) == want or cut and x <= want[0] and y <= want[1]


def test_links_of_a_block_grow_with_its_rows():
    """Near copies of some texts around one place: fewer links than rows, and of two that have a passage the later one has a link to an earlier one."""
    rng = random.Random(17)
    originals = [[rng.randrange(5000) for _ in range(120)] for _ in range(5)]
    texts = [edited(rng, originals[i % 5], i % 7) for i in range(200)]
    left, right = near_words(texts)
    cell = np.repeat([0, 1], 100)
    links = [(a, b) for s, t in H.new_links(left, right, cell, np.zeros(200, int), lambda a, b: a >= 0, 50) for a, b in zip(s.tolist(), t.tolist())]
    assert 150 < len(links) < 200
    linked = {b for _, b in links}
    a, b = np.triu_indices(200, 1)
    a, b = a[cell[a] == cell[b]], b[cell[a] == cell[b]]
    sides = [H.walks(v[a], v[b]) for v in (left, right)]
    long = np.minimum(sides[0][0] + sides[1][0], sides[0][1] + sides[1][1]) >= H.MIN_WORDS
    assert long.sum() > 1000 and set(b[long].tolist()) <= linked
    assert all(a < b and a // 100 == b // 100 for a, b in links)


def test_links_of_rows_of_one_word():
    """Each row of a repeated word is linked to the longest earlier one that no longer one came before, as far as its own words go."""
    sizes = [60, 500, 80, 400, 45, 450]
    left, right = near_words([[7] * 200] * len(sizes), 100)
    links = {(a, b) for s, t in H.new_links(left, right, np.zeros(6, int), np.array(sizes), lambda a, b: a >= 0) for a, b in zip(s.tolist(), t.tolist())}
    for b in range(1, 6):
        assert max(min(sizes[a], sizes[b]) for a, c in links if c == b) == max(min(sizes[a], sizes[b]) for a in range(b))
    assert len(links) < 15


def test_roots_follow_labels():
    cell = np.array([0, 0, 0, 0, 1])
    key, label = np.array([1, 2, 3, 4, 3]), np.array([1, 1, 2, 4, 2])
    one, two, three, four, other = H.roots(cell, key, label).tolist()
    assert one == two == three and four != one and other not in (one, four)
