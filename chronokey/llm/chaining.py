"""Substring deduplication: shared seeds, collinear chains, alignment into fuzzy passages.

1. Seeds are minimizers of word k-mers: of any WINDOW consecutive k-mers, the
   smallest hash. An exact stretch of K + WINDOW - 1 words always shares one.
2. Seeds that stand in more than one text link each of those texts to one holder
   (the text with the smallest id), so links grow with the seeds, not with pairs. Pairs of
   seeds that no passage with a common holder covers do the same once more, then all
   places of such a pair of seeds are compared and aligned, in blocks, smallest id first;
   of those that passages connect no more pairs are reported than connect them.
3. The links of a pair of texts are chained: ordered in both texts, with costs for
   the gaps, by a Fenwick tree over places. Chains shorter than LEAST_CHAIN words go.
4. Chains are aligned word by word and extended at both ends through substitutions,
   insertions and deletions. Where an alignment stops inside a chain, the next one starts
   at the next link behind the stop. Passages of MIN_WORDS words or more are reported.

Texts that are equal are one class; each further copy is reported as one passage
against the row that stands for its class. Texts are known by a 64-bit key.

Cases: a null text is empty. Texts of fewer than MIN_WORDS words have no passages. Rows
with null ids are reported with a null id. Repeated rows are copies of each other. An
empty table gives an empty result. Other columns are ignored. Repeats inside one text are
not passages across documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import shingles
from .common import runs, saved, small, text_or_empty

K, WINDOW = 6, 6
#: Words of a passage, words that a chain spans at least, largest gap inside a passage, cost of a word of gap.
MIN_WORDS, LEAST_CHAIN, MAX_GAP, GAP_COST = 45, 20, 40, 0.1
#: Alignment: words looked ahead after a difference, words that must agree to go on, and the loss that ends it.
AHEAD, AGREE, DROP = 8, 3, 12
#: Comparisons of places: rows of a block, pairs compared at once, the byte and the 16 bits that stand for no word.
BLOCK, PAIRS, PAD, BLANK = 2048, 100_000, 255, 65535
#: Words compared to each side: as many as tell whether an alignment of less than MIN_WORDS equal words goes on.
NEAR = MIN_WORDS + DROP // 2 + AGREE
#: Labels of the first and of the second of two seeds: by the stars of seeds, then by those of seed pairs.
TAGS, MORE_TAGS = ["l1", "l2"], ["m1", "m2"]


def sliding(h: np.ndarray, w: int, best) -> np.ndarray:
    """best over h[i : i + w] for every i with a whole window."""
    out, span = h, 1
    while span * 2 <= w:
        out = best(out[:-span], out[span:])
        span *= 2
    return best(out[:len(h) - w + 1], out[w - span:len(h) - span + 1]) if span < w else out


def minimizers(texts: list[str], k: int = K, w: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, word place, hash) of the seeds of each text."""
    h, _, _, first = shingles.word_hashes(texts)
    if len(h) < k:
        return (np.zeros(0, np.int64),) * 2 + (np.zeros(0, np.uint64),)
    whole = shingles.runs_of(h, k)
    sizes = np.maximum(np.diff(first) - k + 1, 0)
    # Texts stand apart by a window of largest values, so no window mixes two of them.
    room = sizes + w
    at = np.cumsum(room) - sizes
    flat = np.full(int(room.sum()) + w, ~np.uint64(0))
    text = np.repeat(np.arange(len(texts)), sizes)
    place = np.arange(len(text)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    flat[at[text] + place] = whole[first[text] + place]
    low = sliding(flat, w, np.minimum)
    # A k-mer is a seed if it is the least of one of its windows.
    high = sliding(np.concatenate([np.zeros(w - 1, np.uint64), low]), w, np.maximum)
    here = at[text] + place
    seed = high[here] == flat[here]
    return text[seed], place[seed], flat[here][seed]


def seeds(texts: DataFrame) -> DataFrame:
    """(h, doc_id, key, pos): seeds of each text (column t) under its 64-bit key."""
    kind = dict(texts.dtypes)["doc_id"]

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for b in batches:
            for a in range(0, b.num_rows, 128):
                ids, keys, part = (c.slice(a, 128) for c in b.columns)
                text, place, h = minimizers(part.to_pylist())
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), ids.take(pa.array(text)), keys.take(pa.array(text)), pa.array(place.astype(np.int32))], ["h", "doc_id", "key", "pos"])

    return texts.select("doc_id", "key", "t").mapInArrow(run, f"h long, doc_id {kind}, key long, pos int")


def chain(x: np.ndarray, y: np.ndarray, k: int = K, cost: float = GAP_COST) -> list[list[int]]:
    """Chains of anchors (x, y) of k words, best first; each anchor is in one chain at most.

    score(i) = k + max(0, max over j before i in both texts of score(j) - cost of the words between).
    The cost splits into sums of j and i, so a Fenwick tree over the places in y holds
    the best score(j) + cost * (x + y) of the anchors with smaller x.
    """
    order = np.lexsort((y, x)).tolist()
    places = np.unique(y)
    rank = (np.searchsorted(places, y) + 1).tolist()
    xs, ys = x.tolist(), y.tolist()
    tree = [(-1e18, -1)] * (len(places) + 1)
    score, back = [0.0] * len(xs), [-1] * len(xs)
    # Where both texts have the anchors in one order, the one before is the best to go on from: score + cost * (x + y) only grows.
    plain = len(xs) > 0 and bool((np.diff(x[order]) > 0).all() and (np.diff(y[order]) > 0).all())
    for n, i in enumerate(order if plain else ()):
        score[i] = float(k)
        if n:
            j = order[n - 1]
            gain = score[j] + cost * (xs[j] + ys[j]) - cost * (xs[i] + ys[i]) + min(k, xs[i] - xs[j], ys[i] - ys[j]) - k
            if gain > 0:
                score[i], back[i] = k + gain, j
    at = len(order) if plain else 0
    while at < len(order):
        upto = at
        while upto < len(order) and xs[order[upto]] == xs[order[at]]:
            upto += 1
        for i in order[at:upto]:  # all of one x look before any of them enters the tree
            best, j = -1e18, -1
            p = rank[i] - 1
            while p > 0:
                if tree[p][0] > best:
                    best, j = tree[p]
                p -= p & -p
            gain = 0.0
            if j >= 0:
                step = min(k, xs[i] - xs[j], ys[i] - ys[j])  # overlapping anchors add only what is new
                gain = best - cost * (xs[i] + ys[i]) + step - k
            score[i], back[i] = (k + gain, j) if gain > 0 else (float(k), -1)
        for i in order[at:upto]:
            entry = (score[i] + cost * (xs[i] + ys[i]), i)
            p = rank[i]
            while p < len(tree):
                if entry[0] > tree[p][0]:
                    tree[p] = entry
                p += p & -p
        at = upto
    used = [False] * len(xs)
    out = []
    for i in sorted(range(len(xs)), key=lambda i: -score[i]):
        links = []
        while i >= 0 and not used[i]:
            used[i] = True
            links.append(i)
            i = back[i]
        if links:
            out.append(links[::-1])
    return out


def stretches(x: np.ndarray, y: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """The anchors (places in x, in y) of the parts of chains without a gap of more than MAX_GAP words that span enough."""
    out = []
    if min(x.max() - x.min(), y.max() - y.min()) + K < LEAST_CHAIN:
        return out
    for links in chain(x, y):
        cx, cy = x[links], y[links]
        cut = np.flatnonzero((np.diff(cx) > MAX_GAP + K) | (np.diff(cy) > MAX_GAP + K)) + 1
        for px, py in zip(np.split(cx, cut), np.split(cy, cut), strict=True):
            if min(px[-1] - px[0], py[-1] - py[0]) + K >= LEAST_CHAIN:
                out.append((px, py))
    return out


def ordered_steps() -> list[tuple[int, int]]:
    """Words to pass in both texts after a difference, nearest first; a step of more words would end the alignment."""
    out = []
    for d in range(1, min(AHEAD, DROP // 2) + 1):
        out += sorted({(d, d), *((d, e) for e in range(d)), *((e, d) for e in range(d))}, key=lambda s: abs(s[0] - s[1]))
    return out


STEPS = ordered_steps()
REACH = max(map(max, STEPS))
RANK = np.full((REACH + 1, REACH + 1), len(STEPS))
RANK[tuple(zip(*STEPS, strict=True))] = np.arange(len(STEPS))


def walk(a: np.ndarray, b: np.ndarray) -> tuple[int, int, int]:
    """Align from the start of both; (words of a, words of b, equal words) at the best end."""
    i = j = same = 0
    score, best = 0, (0, 0, 0, 0)
    view = 64
    while i < len(a) and j < len(b):
        n = min(len(a) - i, len(b) - j, view)
        differ = np.flatnonzero(a[i:i + n] != b[j:j + n])
        run = int(differ[0]) if len(differ) else n
        i, j, same, score = i + run, j + run, same + run, score + run
        if score >= best[0]:
            best = (score, i, j, same)
        if not len(differ):
            view *= 2
            continue
        view = 64
        # The nearest place from which AGREE words are equal again.
        equal = a[i:i + REACH + AGREE, None] == b[None, j:j + REACH + AGREE]
        rows, cols = (max(n - AGREE + 1, 0) for n in equal.shape)
        agree = equal[:rows, :cols]
        for d in range(1, AGREE):
            agree = agree & equal[d:d + rows, d:d + cols]
        nearest = int(RANK[:rows, :cols][agree].min(initial=len(STEPS)))
        if nearest == len(STEPS):
            break
        step = STEPS[nearest]
        i, j, score = i + step[0], j + step[1], score - 2 * max(step)
        if score < best[0] - DROP:
            break
    return best[1:]


def walks(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``walk`` from the start of each row of two tables of words (BLANK: none): words of a, words of b, and whether the rows end before it does."""
    n, w = a.shape
    wide = w + REACH + AGREE
    x, y = np.full((2, n, wide), BLANK, np.uint16)
    x[:, :w], y[:, :w] = a, b
    none = np.iinfo(np.uint64).max
    grams = []
    for i, v in enumerate((x, y)):
        v = v.astype(np.uint64)
        gram = v[:, :-2] << np.uint64(32) | v[:, 1:-1] << np.uint64(16) | v[:, 2:]
        gram[(v[:, :-2] == BLANK) | (v[:, 1:-1] == BLANK) | (v[:, 2:] == BLANK)] = none - np.uint64(i)
        grams.append(gram.ravel())
    x, y, gram_wide = x.ravel(), y.ravel(), wide - 2
    i, j, score, best, words_a, words_b = np.zeros((6, n), np.int64)
    cut = np.zeros(n, bool)
    live = np.arange(n)
    while len(live):
        p, q = i[live], j[live]
        cols = np.arange(w)
        one = x[(live * wide)[:, None] + np.minimum(p[:, None] + cols, wide - 1)]
        differ = np.ones((len(live), w + 1), bool)
        differ[:, :w] = (one != y[(live * wide)[:, None] + np.minimum(q[:, None] + cols, wide - 1)]) | (one == BLANK)
        run = differ.argmax(axis=1)
        p, q = p + run, q + run
        s = score[live] + run
        up = s >= best[live]
        best[live[up]], words_a[live[up]], words_b[live[up]] = s[up], p[up], q[up]
        ends = np.maximum(p, q) + REACH + AGREE > w
        cut[live[ends]] = True
        live, p, q, s = live[~ends], p[~ends], q[~ends], s[~ends]
        step = np.full(len(live), -1)
        for k, (di, dj) in enumerate(STEPS):
            rest = np.flatnonzero(step < 0)
            at = live[rest] * gram_wide
            step[rest[grams[0][at + p[rest] + di] == grams[1][at + q[rest] + dj]]] = k
        found = step >= 0
        live, p, q, s = live[found], p[found], q[found], s[found]
        di, dj = np.array(STEPS)[step[found]].reshape(-1, 2).T
        i[live], j[live], score[live] = p + di, q + dj, s - 2 * np.maximum(di, dj)
        live = live[score[live] >= best[live] - DROP]
    return words_a, words_b, cut


def align(a: np.ndarray, b: np.ndarray, parts: list[tuple[np.ndarray, np.ndarray]]) -> list[tuple[int, int, int, int, int]]:
    """(start, end in a, start, end in b, equal words) of the passages around chained parts, longest part first.

    An alignment that stops before the last anchor of its part starts again from the next anchor behind the stop.
    """
    out: list[tuple[int, int, int, int, int]] = []
    for xs, ys in sorted(parts, key=lambda p: int(p[0][0]) - int(p[0][-1])):
        end_x = end_y = -1
        for x, y in zip(map(int, xs), map(int, ys), strict=True):
            if x < end_x and y < end_y or any(s <= x < e and t <= y < f for s, e, t, f, _ in out):
                continue  # inside what was walked from an anchor before it, or a passage found from another chain
            left, right = walk(a[:x][::-1], b[:y][::-1]), walk(a[x:], b[y:])
            end_x, end_y = x + right[0], y + right[1]
            found = (x - left[0], end_x, y - left[1], end_y, left[2] + right[2])
            if min(found[1] - found[0], found[3] - found[2]) >= MIN_WORDS:
                out = [o for o in out if not (found[0] <= o[0] and o[1] <= found[1] and found[2] <= o[2] and o[3] <= found[3])]
                out.append(found)
    return out


def shared_seeds(texts: DataFrame) -> DataFrame:
    """(h, key, pos, a, x, two): places of seeds that stand in several texts; a holds the seed at x; two: it has two places in all."""
    found = seeds(texts)
    # Counts of numbers are kept in hash tables; the holder, a row, is looked for among the seeds that are left.
    several = (found.groupBy("h").agg(F.min("key").alias("lo"), F.max("key").alias("hi"), F.count("*").alias("n"))
               .filter("lo != hi").select("h", (F.col("n") == 2).alias("two")))
    # Written tables, so that the joins have two plain exchanges and the places of a very common seed can be split.
    found = saved(found.join(saved(several, "several").hint("shuffle_hash"), "h"), "repeated")
    holders = (found.groupBy("h").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "key", "pos")).alias("first"))
               .select("h", F.col("first.key").alias("a"), F.col("first.pos").alias("x")))
    return saved(found.select("h", "key", "pos", "two").join(saved(holders, "holders").hint("shuffle_hash"), "h").select("h", "key", "pos", "a", "x", "two"), "shared")


def seed_links(shared: DataFrame) -> DataFrame:
    """(a, b, x, y): place x of holder a, the text with the smallest id (nulls last), shares a seed with place y of text b.

    This links texts in stars; what the stars leave out is found by ``open_seeds`` and ``rest_links``.
    """
    return shared.filter("key != a").select("a", F.col("key").alias("b"), "x", F.col("pos").alias("y")).distinct()


def repeats(what: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether each place, sorted by (what, at), goes on the row of places in equal steps of up to K words before it, and whether the next one does."""
    step = np.where(what[1:] == what[:-1], at[1:] - at[:-1], K + 1)
    # A step belongs to a row if it is short and like the one before or behind it.
    like = (step[1:] == step[:-1]) & (step[1:] <= K)
    inside = np.zeros(len(step), bool)
    inside[1:] |= like
    inside[:-1] |= like
    first = np.zeros(min(len(at), 1), bool)
    return np.concatenate([first, inside]), np.concatenate([inside, first])


def parts(batch, most: int = 20_000) -> Iterator[list]:
    """The columns of a batch, the second of which holds lists, in runs of rows that have at most so many elements, or one row."""
    upto = np.cumsum(batch.column(1).value_lengths().to_numpy())
    s = 0
    while s < batch.num_rows:
        e = max(s + 1, int(np.searchsorted(upto, (upto[s - 1] if s else 0) + most, "right")))
        yield [c.slice(s, e - s) for c in batch.columns]
        s = e


def label_spans(passages: DataFrame, names: DataFrame) -> DataFrame:
    """(key, spans): the places (label, s, e) of each text in ``passages``, smallest id of the holder first. ``names``: key, other_id."""
    fields = ("label", "s", "e")
    sides = [passages.select(F.col(key).alias("key"), F.col("a").alias("label"), F.col(s).alias("s"), F.col(e).alias("e"))
             for key, s, e in (("a", "other_start_word", "other_end_word"), ("b", "start_word", "end_word"))]
    return (sides[0].unionByName(sides[1]).groupBy("key", "label", "s").agg(F.max("e").alias("e"))
            .join(names.select(F.col("key").alias("label"), "other_id", F.col("other_id").isNull().alias("no_id")), "label")
            .groupBy("key").agg(F.array_sort(F.collect_list(F.struct("no_id", "other_id", *fields))).alias("spans"))
            .select("key", F.transform("spans", lambda v: F.struct(*[v[c].alias(c) for c in fields])).alias("spans")))


def open_seeds(shared: DataFrame, names: DataFrame, passages: DataFrame) -> DataFrame:
    """(h, key, pos, two, l): places of the seeds whose places have several labels.

    A place inside one of the ``passages`` has the holder of such a passage as label, the seed's own one if it
    can be, else that of the smallest id (``names``: key, other_id); any other place its own text. Where words repeat
    (places of a seed in equal steps of up to K words) the places have one label. Texts whose places
    of a seed have equal labels are linked already, by passages with that holder.
    """
    rows = (shared.groupBy("key").agg(F.collect_set(F.struct("h", "pos", "two", "a")).alias("seeds"))
            .join(label_spans(passages, names), "key", "left"))

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        none = 1 << 40
        for batch in batches:
            for keys, lists, more in parts(batch):
                h, pos, two, holder = lists.flatten().flatten()
                first = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())])
                at, holder = pos.to_numpy(), holder.to_numpy()
                label = np.repeat(keys.to_numpy(), np.diff(first))
                for i in np.flatnonzero(more.is_valid().to_numpy(zero_copy_only=False)).tolist():
                    spans = list(zip(*(c.to_numpy().tolist() for c in more.slice(i, 1).flatten().flatten()), strict=True))
                    part = slice(first[i], first[i + 1])
                    x, own, seed = at[part], holder[part], h.to_numpy()[part]
                    rank, labels = np.full(len(x), none), np.array([*(a for a, _, _ in spans), keys[i].as_py()])
                    for j, (a, s, e) in enumerate(spans):
                        rank = np.where((s <= x) & (x + K <= e), np.minimum(rank, np.where(own == a, j - none, j)), rank)
                    order = np.lexsort((x, seed))
                    begin = np.flatnonzero(~repeats(seed[order], x[order])[0])
                    if len(begin) < len(order):
                        rank[order] = np.repeat(np.minimum.reduceat(rank[order], begin), np.diff(np.append(begin, len(order))))
                    label[part] = labels[np.where(rank == none, len(labels) - 1, rank % none)]
                yield pa.RecordBatch.from_arrays([h, keys.take(pa.array(np.repeat(np.arange(len(keys)), np.diff(first)))), pos, two, pa.array(label)], ["h", "key", "pos", "two", "l"])

    places = saved(rows.select("key", "seeds", "spans").mapInArrow(run, "h long, key long, pos int, two boolean, l long"), "places")
    return places.join(several(places, "h", ["l"]).hint("shuffle_hash"), "h", "left_semi")


def several(rows: DataFrame, by: str, labels: list[str]) -> DataFrame:
    """The values of ``by`` whose rows have more than one value of each label."""
    ends = rows.groupBy(by).agg(*[f(c).alias(f"{f.__name__}_{c}") for c in labels for f in (F.min, F.max)])
    return ends.filter(" and ".join(f"min_{c} != max_{c}" for c in labels)).select(by)


def seed_pairs(places: DataFrame) -> DataFrame:
    """(g, key, x, gap, l1, l2, row): each open seed with each other one that can make a chain with it; g stands for both seeds.

    A chain has two links LEAST_CHAIN - K to LEAST_CHAIN + MAX_GAP words apart. Each of both is x once, the other one is gap words behind.
    Two seeds with two places each were chained with their holder. Of equal pairs at places in equal steps of up to
    K words (so the words repeat there) the first and the last are kept: repeats agree best from their starts or from their ends. ``row``: where MIN_WORDS
    words or more repeat, how many, below 0 at the last place; else 0.
    """
    rows = places.groupBy("key").agg(F.collect_list(F.struct("pos", "h", "two", "l")).alias("seeds"))

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for keys, lists in parts(batch):
                pos, h, two, label = lists.flatten().flatten()
                # Texts stand so far apart that no pair and no row of places mixes two of them.
                text = np.repeat(np.arange(len(keys)), lists.value_lengths().to_numpy())
                apart = int(pos.to_numpy().max()) + 2 * (LEAST_CHAIN + MAX_GAP)
                at, two = pos.to_numpy() + text * apart, two.to_numpy(zero_copy_only=False)
                order = np.argsort(at, kind="stable")
                at, two, h, label = at[order], two[order], h.to_numpy()[order].view(np.uint64), label.to_numpy()[order]
                low, high = np.searchsorted(at, at + LEAST_CHAIN - K), np.searchsorted(at, at + LEAST_CHAIN + MAX_GAP, "right")
                n = high - low
                one = np.repeat(np.arange(len(at)), n)
                other = np.arange(len(one)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low, n)
                keep = ~(two[one] & two[other])
                one, other = one[keep], other[keep]
                if not len(one):
                    continue
                g = shingles.mix(h[one] * np.uint64(0x9E3779B97F4A7C15) + h[other])
                g = np.concatenate([g, ~g]).view(np.int64)
                one, other = np.concatenate([one, other]), np.concatenate([other, one])
                x, gap = at[one], at[other] - at[one]
                order = np.lexsort((np.abs(gap), x, g))
                g, x, gap, one, other = (v[order] for v in (g, x, gap, one, other))
                first = np.concatenate([[True], (g[1:] != g[:-1]) | (x[1:] != x[:-1])])
                g, x, gap, one, other = (v[first] for v in (g, x, gap, one, other))
                tags = np.array([label[one], label[other]])
                back, ahead = repeats(g, x)
                begin = np.flatnonzero(~back)
                row = np.repeat(np.maximum.reduceat(x + np.abs(gap), begin) - x[begin] + K, np.diff(np.append(begin, len(x))))
                row[(row < MIN_WORDS) | ~(back | ahead)] = 0
                same = (tags[:, 1:] == tags[:, :-1]).all(axis=0)
                back[1:] &= same
                ahead[:-1] &= same
                row[back] *= -1
                end = ~(back & ahead)
                g, x, gap, tags, row = g[end], x[end], gap[end], tags[:, end], row[end]
                yield pa.RecordBatch.from_arrays([pa.array(g), keys.take(pa.array(x // apart)), pa.array((x % apart).astype(np.int32)), pa.array(gap.astype(np.int32)),
                                                  *(pa.array(v) for v in tags), pa.array(row.astype(np.int32))], ["g", "key", "x", "gap", *TAGS, "row"])

    pairs = saved(rows.mapInArrow(run, "g long, key long, x int, gap int, " + ", ".join(f"{c} long" for c in TAGS) + ", row int"), "seed-pairs")
    return saved(pairs.join(several(pairs, "g", TAGS).hint("shuffle_hash"), "g", "left_semi"), "open-pairs")


def still_open(pairs: DataFrame, names: DataFrame, passages: DataFrame) -> DataFrame:
    """The pairs of seeds with labels m1 and m2, as l1 and l2 but by the ``passages`` of the stars of pairs; those that have several labels each way."""
    rows = pairs.groupBy("key").agg(F.collect_list(F.struct("g", "x", "gap", "row", *TAGS)).alias("pairs")).join(label_spans(passages, names), "key", "left")

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for i in range(batch.num_rows):
                key = batch.column(0)[i].as_py()
                cols = batch.column(1).slice(i, 1).flatten().flatten()
                x, gap = (c.to_numpy() for c in cols[1:3])
                own = np.full(len(x), key)
                more = [own.copy(), own.copy()]
                if batch.column(2)[i].is_valid:
                    spans = list(zip(*(c.to_numpy().tolist() for c in batch.column(2).slice(i, 1).flatten().flatten()), strict=True))
                    for label, at in zip(more, (x, x + gap), strict=True):
                        for a, s, e in reversed(spans):
                            label[(s <= at) & (at + K <= e)] = a
                yield pa.RecordBatch.from_arrays([*cols, *(pa.array(v) for v in more), pa.array(own)], ["g", "x", "gap", "row", *TAGS, *MORE_TAGS, "key"])

    tags = [*TAGS, *MORE_TAGS]
    labelled = saved(rows.select("key", "pairs", "spans").mapInArrow(run, "g long, x int, gap int, row int, " + ", ".join(f"{c} long" for c in tags) + ", key long"), "labelled-pairs")
    return labelled.join(several(labelled, "g", tags), "g", "left_semi")


def both_links(pairs: DataFrame) -> DataFrame:
    """(a, b, x, y) of both seeds of (a, b, x, gap, y, other_gap)."""
    return pairs.select("a", "b", F.inline(F.array(F.struct("x", "y"), F.struct((F.col("x") + F.col("gap")).alias("x"), (F.col("y") + F.col("other_gap")).alias("y"))))).distinct()


def pair_links(pairs: DataFrame, names: DataFrame) -> DataFrame:
    """Stars of seed pairs: links of the text with the smallest id that has the pair to all others. ``names``: (key, other_id).

    Rows of repeated words that are passages by themselves have a star of their own, since all of them agree.
    """
    pairs = pairs.withColumn("row", F.col("row") != 0)
    rows = pairs.join(names, "key")
    first = rows.groupBy("g", "row").agg(F.min(F.struct(F.col("other_id").isNull().alias("no_id"), "other_id", "key", "x", "gap", *TAGS)).alias("first"))
    first = first.select("g", "row", F.col("first.key").alias("a"), *[F.col(f"first.{c}").alias(f"a_{c}") for c in ("x", "gap", *TAGS)])
    met = pairs.join(first, ["g", "row"]).filter(" and ".join(["key != a", *(f"{c} != a_{c}" for c in TAGS)]))
    return both_links(met.select("a", F.col("key").alias("b"), F.col("a_x").alias("x"), F.col("a_gap").alias("gap"), F.col("x").alias("y"), F.col("gap").alias("other_gap")))


def may_step(a: np.ndarray, b: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether ``walk`` may go on behind a difference at ``at``: three words agree a few words behind it, or can't be seen."""
    reach = DROP // 2
    cols = np.minimum(at[:, None] + np.arange(reach + AGREE), a.shape[1] - 1)
    out = at + reach + AGREE > a.shape[1]
    x, y = np.take_along_axis(a, cols, 1).astype(np.uint32), np.take_along_axis(b, cols, 1).astype(np.uint32)
    grams = [v[:, :-2] << 16 | v[:, 1:-1] << 8 | v[:, 2:] for v in (x, y)]
    seen = (x[:, :-2] != PAD) & (x[:, 1:-1] != PAD) & (x[:, 2:] != PAD)
    for d in range(reach + 1):
        out |= ((grams[0] == grams[1][:, d, None]) & seen).any(axis=1)
    return out


def may_pass(left: np.ndarray, right: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether the alignments from rows a and b may be passages: equal words enough, or a step over the first difference of a side."""
    ends, sides = [], []
    for words in (left, right):
        x, y = words[a], words[b]
        differ = np.ones((len(a), words.shape[1] + 1), bool)
        differ[:, :-1] = (x != y) | (x == PAD)
        ends.append(differ.argmax(axis=1))
        sides.append((x, y))
    out = ends[0] + ends[1] >= MIN_WORDS
    for (x, y), end in zip(sides, ends, strict=True):
        rest = np.flatnonzero(~out)
        out[rest] = may_step(x[rest], y[rest], end[rest])
    return out


def roots(cell: np.ndarray, key: np.ndarray, label: np.ndarray) -> np.ndarray:
    """The text that each row's label leads to: its own label, or the one of that text's rows in the cell, and so on."""
    values, at = np.unique(np.concatenate([key, label]), return_inverse=True)
    number = np.concatenate([cell, cell]) * len(values) + at
    _, node = np.unique(number, return_inverse=True)
    own, to = node[:len(key)], node[len(key):]
    low, high = np.full(len(node), len(node)), np.full(len(node), -1)
    np.minimum.at(low, own, to)
    np.maximum.at(high, own, to)
    # A text whose rows have several labels leads nowhere.
    parent = np.where(low == high, low, np.arange(len(node)))
    for _ in range(12):
        parent = parent[parent]
    return parent[to]


def new_links(left: np.ndarray, right: np.ndarray, cell: np.ndarray, row: np.ndarray, allowed, pairs: int = PAIRS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows (a, b) of one cell whose words have a passage and that no passages found before connect.

    ``cell`` numbers the cells, in ascending order; the rows of one ascend by id, and each is compared with those behind it, in that order,
    so that of two rows left out the later one has a passage with an earlier one. ``allowed``: whether rows a and b are to be compared.
    Links are no more than the rows, but for those whose words end before the alignment does. Where words repeat in both texts (``row``),
    places inside are not listed, so such a pair is left out only if an earlier one had as many words of the later row.
    """
    size, last = np.abs(row), (row < 0).astype(int)
    had = np.zeros((2, len(cell)), np.int64)
    tiny = [np.where(v == BLANK, PAD, v % PAD).astype(np.uint8) for v in (left, right)]
    start = np.concatenate([[0], np.flatnonzero(cell[1:] != cell[:-1]) + 1])
    sizes = np.diff(np.append(start, len(cell)))
    rank = np.arange(len(cell)) - np.repeat(start, sizes)
    behind = np.repeat(sizes, sizes) - 1 - rank
    lead = np.lexsort((np.arange(len(cell)), rank))
    upto = np.cumsum(behind[lead])
    parent = np.arange(len(cell))
    s = 0
    while s < len(lead):
        e = max(s + 1, int(np.searchsorted(upto, (upto[s - 1] if s else 0) + pairs, "right")))
        if not rank[lead[s]]:  # the first rows by themselves: groups of like rows are one then
            e = min(e, len(start))
        n = behind[lead[s:e]]
        a = np.repeat(lead[s:e], n)
        b = a + 1 + np.arange(len(a)) - np.repeat(np.cumsum(n) - n, n)
        s = e
        words = np.minimum(size[a], size[b])
        keep = np.where(words > 0, words > had[last[a], b], parent[a] != parent[b])
        a, b = a[keep], b[keep]
        keep = allowed(a, b)
        a, b = a[keep], b[keep]
        keep = may_pass(*tiny, a, b)
        a, b = a[keep], b[keep]
        if not len(a):
            continue
        sides = [walks(v[a], v[b]) for v in (left, right)]
        long = np.minimum(sides[0][0] + sides[1][0], sides[0][1] + sides[1][1]) >= MIN_WORDS
        open_end = ~long & (sides[0][2] | sides[1][2])
        out = []
        tree = parent.tolist()
        for p, q, sure in zip(a[long | open_end].tolist(), b[long | open_end].tolist(), long[long | open_end].tolist(), strict=True):
            words = min(size[p], size[q])
            if sure and words:
                if words <= had[last[p], q]:
                    continue
                had[last[p], q] = words
            elif sure:
                u, v = p, q
                while tree[u] != u:
                    tree[u] = u = tree[tree[u]]
                while tree[v] != v:
                    tree[v] = v = tree[tree[v]]
                if u == v:
                    continue
                tree[max(u, v)] = min(u, v)
            out.append((p, q))
        parent = np.array(tree)
        while (parent[parent] != parent).any():
            parent = parent[parent]
        if out:
            yield tuple(np.array(v) for v in zip(*out, strict=True))


def rest_links(pairs: DataFrame, names: DataFrame, bodies: DataFrame) -> DataFrame:
    """(a, b, parts): places in pairs of texts that share two seeds, have other labels at both and have a passage there.

    The places of a pair of seeds are compared in blocks by their NEAR words to both sides, 16 bits for each. Of places that
    passages connect (those of the labels, or found in the block) no more are reported than connect them.
    """
    tags = [*TAGS, *MORE_TAGS]
    fields = ("g", "x", "row", *tags)
    listed = (pairs.groupBy("key").agg(F.collect_list(F.struct(*fields)).alias("places")).join(bodies, "key")
              .join(names.select("key", "other_id"), "key").select("key", "other_id", "places", "z"))

    def around(batches: Iterator) -> Iterator:
        import pyarrow as pa
        import zstandard

        unpack = zstandard.ZstdDecompressor().decompress
        pad = np.full(NEAR, BLANK, np.uint16)
        for batch in batches:
            for i in range(batch.num_rows):
                cols = batch.column(2).slice(i, 1).flatten().flatten()
                words = shingles.word_hashes([unpack(batch.column(3)[i].as_py()).decode()])[0]
                near = np.concatenate([pad, (words % np.uint64(BLANK)).astype(np.uint16), pad])
                at = cols[1].to_numpy().astype(np.int64)[:, None] + NEAR
                for s in range(0, len(at), 5000):
                    part = at[s:s + 5000]
                    flat = np.concatenate([near[part - 1 - np.arange(NEAR)], near[part + np.arange(NEAR)]], axis=1)
                    kept = pa.FixedSizeBinaryArray.from_buffers(pa.binary(4 * NEAR), len(part), [None, pa.py_buffer(flat.tobytes())]).cast(pa.binary())
                    key, name = (batch.column(c).slice(i, 1).take(pa.array(np.zeros(len(part), np.int64))) for c in (0, 1))
                    yield pa.RecordBatch.from_arrays([*(c.slice(s, 5000) for c in cols), key, name, kept], [*fields, "key", "other_id", "near"])

    rows = listed.mapInArrow(around, "g long, x int, row int, " + ", ".join(f"{c} long" for c in tags) + f", key long, other_id {dict(names.dtypes)['other_id']}, near binary")
    blocks = pairs.groupBy("g").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    many = small(blocks.filter("blocks > 1"))
    own = F.pmod(F.xxhash64("key", "x"), F.coalesce("blocks", F.lit(1))).cast("int")
    dealt = (rows.join(many, "g", "left").withColumn("own", own)
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.coalesce("blocks", F.lit(1)) - 1)))
             .withColumn("side", F.when(F.col("own") == F.col("other"), 0).otherwise(F.when(F.col("own") < F.col("other"), 1).otherwise(2)))
             .withColumn("cell", F.xxhash64("g", F.least("own", "other"), F.greatest("own", "other")))
             .withColumn("no_id", F.col("other_id").isNull()))
    dealt = dealt.repartition(F.col("cell")).sortWithinPartitions("cell", "no_id", "other_id", "key", "x").select("cell", "side", "key", *fields, "near")

    def compare(batches: Iterator) -> Iterator:
        import pyarrow as pa

        def met(tables: list) -> Iterator:
            table = pa.concat_tables(tables).combine_chunks()
            cell, side, key, g, x, row, *labels = (table.column(c).to_numpy() for c in ("cell", "side", "key", *fields))
            near = np.frombuffer(b"".join(table.column("near").to_pylist()), np.uint16).reshape(-1, 2 * NEAR)
            cell = np.cumsum(np.concatenate([[0], cell[1:] != cell[:-1]]))
            ends = [roots(cell, key, label) for label in labels]

            def allowed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
                keep = (key[a] != key[b]) & (g[a] == g[b]) & ((side[a] == 0) | (side[a] != side[b]))
                repeat = (row[a] != 0) & (row[b] != 0)
                for label, end in zip(labels, ends, strict=True):
                    keep &= np.where(repeat, label[a] != label[b], end[a] != end[b])
                return keep

            for a, b in new_links(near[:, :NEAR], near[:, NEAR:], cell, row, allowed):
                a, b = np.where(key[a] < key[b], a, b), np.where(key[a] < key[b], b, a)
                yield pa.RecordBatch.from_arrays([pa.array(v) for v in (key[a], key[b], x[a], x[b])], ["a", "b", "x", "y"])

        held, size = [], 0
        for _, table in runs(batches, "cell"):
            if table.num_rows > 1:
                held.append(table)
                size += table.num_rows
            if size >= 4 * BLOCK:
                yield from met(held)
                held, size = [], 0
        if held:
            yield from met(held)

    links = dealt.mapInArrow(compare, "a long, b long, x int, y int")
    anchors = links.groupBy("a", "b").agg(F.array_sort(F.collect_set(F.struct("x", "y"))).alias("anchors"))
    return anchors.select("a", "b", F.transform("anchors", lambda v: F.struct(F.array(v["x"]).alias("xs"), F.array(v["y"]).alias("ys"))).alias("parts"))


def chained(links: DataFrame) -> DataFrame:
    """(a, b, parts): anchors of the chained stretches of each pair of texts that has any."""
    rows = links.withColumn("pair", F.xxhash64("a", "b")).repartition(F.col("pair")).sortWithinPartitions("pair", "a", "b")

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        kind = pa.list_(pa.struct([(c, pa.list_(pa.int32())) for c in ("xs", "ys")]))
        out: list = []

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], pa.int64()), pa.array([o[2] for o in out], kind)], ["a", "b", "parts"])

        for _, table in runs(batches, "pair"):
            if table.num_rows < 2:
                continue
            a, b, x, y = (table.column(c).to_numpy() for c in ("a", "b", "x", "y"))
            cuts = np.flatnonzero((a[1:] != a[:-1]) | (b[1:] != b[:-1])) + 1
            for s, e in zip([0, *cuts], [*cuts, len(a)], strict=True):
                parts = stretches(x[s:e], y[s:e])
                if parts:
                    out.append((a[s], b[s], [{"xs": px.tolist(), "ys": py.tolist()} for px, py in parts]))
            if len(out) >= 2000:
                yield batch()
                out.clear()
        yield batch()

    return rows.mapInArrow(run, "a long, b long, parts array<struct<xs:array<int>,ys:array<int>>>")


def aligned(pairs: DataFrame, bodies: DataFrame) -> DataFrame:
    """(a, b, passages) of chained pairs. ``bodies``: (key, z)."""
    side = lambda key, z: bodies.select(F.col("key").alias(key), F.col("z").alias(z))
    rows = pairs.join(side("b", "zb"), "b").join(side("a", "za"), "a").select("a", "b", "parts", "za", "zb")
    fields = ("start_word", "end_word", "start", "end", "other_start_word", "other_end_word", "other_start", "other_end", "same")

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        import zstandard

        unpack = zstandard.ZstdDecompressor().decompress
        held: dict = {}

        def words(key: int, z: bytes):
            if key not in held:
                if len(held) > 100:
                    held.clear()
                held[key] = shingles.word_hashes([unpack(z).decode()])[:3]
            return held[key]

        for batch in batches:
            out: list = []
            for a, b, parts, za, zb in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                (ha, sa, ea), (hb, sb, eb) = words(a, za), words(b, zb)
                for x0, x1, y0, y1, same in align(ha, hb, [(p["xs"], p["ys"]) for p in parts]):
                    out.append((a, b, y0, y1, int(sb[y0]), int(eb[y1 - 1]), x0, x1, int(sa[x0]), int(ea[x1 - 1]), same))
            cols = list(zip(*out, strict=True)) or [()] * 11
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["a", "b", *fields])

    return rows.mapInArrow(run, "a long, b long, " + ", ".join(f"{f} long" for f in fields))


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per passage: doc_id and its span, other_id and its span, n_words, identity.

    Spans are words and code points, end exclusive. ``doc_id`` is the larger of the two ids (a null
    one the largest); a removal of the spans of ``doc_id`` leaves every passage once.
    """
    kind = dict(docs.dtypes)[id_col]
    texts = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("t"))
    texts = texts.select("doc_id", F.xxhash64("t", F.lit(7)).alias("key"), "t")
    shared = shared_seeds(texts)

    def press(batches: Iterator) -> Iterator:
        import pyarrow as pa
        import zstandard

        c = zstandard.ZstdCompressor(level=3)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([c.compress(t.encode()) for t in b.column(1).to_pylist()], pa.binary())], ["key", "z"])

    def bodies(keys: DataFrame) -> DataFrame:
        return saved(texts.join(small(keys.distinct()), "key", "left_semi").select("key", "t").mapInArrow(press, "key long, z binary")
                     .groupBy("key").agg(F.first("z").alias("z")), "bodies")

    def passages_of(parts: DataFrame, held: DataFrame | None = None) -> DataFrame:
        chains = saved(parts, "chains")
        return saved(aligned(chains, bodies(chains.select(F.col("a").alias("key")).union(chains.select("b"))) if held is None else held), "passages")

    found = passages_of(chained(seed_links(shared)))
    smallest = saved(texts.groupBy("key").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id")).alias("first"))
                     .select("key", F.col("first.doc_id").alias("other_id")), "ids")
    pairs = seed_pairs(open_seeds(shared, smallest, found))
    held = bodies(pairs.select("key"))
    again = passages_of(chained(pair_links(pairs, smallest)), held)
    rest = passages_of(rest_links(still_open(pairs, smallest, again), smallest, held), held)
    found = found.unionByName(again).unionByName(rest).distinct()

    # Equal texts: the smallest id stands for its class, the others repeat it.
    rows = saved(texts.select("doc_id", "key", F.length("t").cast("long").alias("chars"), F.monotonically_increasing_id().alias("rid")), "texts")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "rid")).alias("first")
    classes = rows.groupBy("key").agg(first).select("key", F.col("first.doc_id").alias("other_id"), F.col("first.rid").alias("first_rid"))
    again_there = rows.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1").select("key")
    sizes = (texts.join(small(again_there), "key", "left_semi").select("key", F.regexp_count("t", F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("words"))
             .groupBy("key").agg(F.max("words").alias("words")))
    zero = F.lit(0).cast("long")
    copies = rows.join(classes, "key").join(sizes, "key").filter((F.col("rid") != F.col("first_rid")) & (F.col("words") >= MIN_WORDS)).select(
        "doc_id", zero.alias("start_word"), F.col("words").alias("end_word"), zero.alias("start"), F.col("chars").alias("end"), "other_id",
        zero.alias("other_start_word"), F.col("words").alias("other_end_word"), zero.alias("other_start"), F.col("chars").alias("other_end"),
        F.col("words").alias("n_words"), F.lit(1.0).alias("identity"))
    names = classes.join(small(found.select(F.col("a").alias("key")).union(found.select("b")).distinct()), "key", "left_semi").select("key", "other_id")
    named = (found.join(names.select(F.col("key").alias("a"), F.col("other_id").alias("ida")), "a")
             .join(names.select(F.col("key").alias("b"), F.col("other_id").alias("idb")), "b"))
    # b has the larger id, also where a pair was met in the order of its keys.
    turn = F.col("ida").isNull() & F.col("idb").isNotNull() | F.coalesce(F.col("ida") > F.col("idb"), F.lit(False))
    sides = [("ida", "idb"), *((f"other_{c}", c) for c in ("start_word", "end_word", "start", "end"))]
    named = named.select("same", *[F.when(turn, F.col(v)).otherwise(F.col(u)).alias(c) for u, w in sides for c, u, v in ((u, u, w), (w, w, u))]).distinct()
    n = F.greatest(F.col("end_word") - F.col("start_word"), F.col("other_end_word") - F.col("other_start_word"))
    passages = named.select(F.col("idb").alias("doc_id"), "start_word", "end_word", "start", "end", F.col("ida").alias("other_id"),
                            "other_start_word", "other_end_word", "other_start", "other_end", n.alias("n_words"), (F.col("same") / n).alias("identity"))
    out = passages.unionByName(copies)
    return out.withColumn("doc_id", F.col("doc_id").cast(kind)).withColumn("other_id", F.col("other_id").cast(kind))
