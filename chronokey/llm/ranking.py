"""Ranked lexical search over a length-stratified index.

A document's normaliser m depends on its length only. Documents of equal m form a stratum;
within it a posting's impact depends on its term and tf alone, so impacts are computed once
for each tf of a stratum, and the largest tf of each term gives an upper bound of any score
in the stratum.

1. Forward index: one pass over the texts (byte translation, split) keeps of each document
   its length and the (term, tf) pairs of terms that items ask for. It is written to the
   shared folder; counts of documents, words and df come from it.
2. Strata: documents are dealt by m, neighbouring small strata together and a stratum of very many
   postings cut by hash, into groups of about ``GROUP_POSTINGS``. A task takes one group at a time.
3. Search: a group's strata are held as postings by term. For each item they are visited
   by falling bound, up to the first whose bound is below the tenth score found.
   What leaves a group is at most ten rows for each item; the ranks are taken over those.

Items are a query set that is held against all documents in blocks: a block's terms (at most
``BLOCK_TERMS`` with repeats, or one longer item) go to the tasks, further items form
further blocks. The documents are never cut: every document is indexed and every stratum
is visited or excluded by its bound, so results are exact.

Weights are doubles rounded down, all else integers. Products and sums stay below 2^53 for
items of up to 300,000 words, so numpy's double sums are exact; longer items are summed in
64-bit integers.

Rules: a null or empty text has no terms and is in no result. Rows that repeat are documents
of their own. Equal scores ascend by doc_id, a null id last. Every row of ``items`` gets its
own list, also where it repeats an id. Empty tables give no rows. Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import runs, saved, small, text_or_empty

# ---- fixed values: the formula of the task ----
TOP = 10
SCALE, TF, NORM, FLOOR, SLOPE = 1_000_000_000, 1000, 8, 100 - 75, 75
# ---- end of fixed values ----

#: Term occurrences of the items of one block.
BLOCK_TERMS = 200_000

#: Postings of one group of strata (about 100 bytes each while it is searched).
GROUP_POSTINGS = 2_000_000

#: Items longer than this are summed in integers.
EXACT_WORDS = 300_000

_INDEX = "doc_id long, n long, ids array<int>, tfs array<int>"

# Bytes of other characters are all above 0x7F in UTF-8, so terms can be cut and lower-cased as bytes.
_BYTES = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20 for b in range(256))


def terms(text: str | None) -> list[bytes]:
    """The terms of a text, as UTF-8 bytes."""
    return text.encode("utf-8", "surrogatepass").translate(_BYTES).split() if text else []


def _item_blocks(items: DataFrame, block_terms: int) -> Iterator[list]:
    """The rows (key, item_id, text) of ``items``, in blocks of a bounded number of terms; one block is held at a time."""
    rows = saved(items.select(F.monotonically_increasing_id().alias("key"), "item_id", text_or_empty("text").alias("text")), "items")
    # A text has at most half as many terms as characters, and one.
    sized = rows.select("key", ((F.length("text") + 1) / 2).cast("long").alias("size"))
    total = sized.agg(F.sum("size")).first()[0] or 0
    n = max(1, -(-total // max(1, block_terms // 2)))  # hashed blocks are uneven, so they aim at half
    for b in range(n):
        block, held = [], 0
        for row in rows.filter(F.pmod(F.xxhash64("key"), F.lit(n)) == b).toLocalIterator():
            row = (row["key"], row["item_id"], terms(row["text"]))
            if block and held + len(row[2]) > block_terms:
                yield block
                block, held = [], 0
            block.append(row)
            held += len(row[2])
        if block:
            yield block


def forward_index(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """doc_id, n (terms of the document), ids and tfs (of the terms in ``vocabulary``) of each document with a term."""

    def index(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        get, width = vocabulary.get, max(1, len(vocabulary))
        for b in batches:
            texts = b.column("text").to_pylist()
            found, lengths = [], np.zeros(len(texts), dtype="int64")
            for i, text in enumerate(texts):
                ws = terms(text)
                lengths[i] = len(ws)
                ids = np.fromiter((x for x in map(get, ws) if x is not None), dtype="int64")
                found.append(ids + i * width)
            keys, tf = np.unique(np.concatenate(found) if found else np.zeros(0, "int64"), return_counts=True)
            ends = np.searchsorted(keys, np.arange(len(texts) + 1) * width).astype("int32")
            lists = [pa.ListArray.from_arrays(pa.array(ends), pa.array(x.astype("int32"))) for x in (keys % width, tf)]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id").cast(pa.int64()), pa.array(lengths), *lists], ["doc_id", "n", "ids", "tfs"]).filter(pa.array(lengths > 0))

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").filter(F.col("text") != "")
    return rows.mapInArrow(index, _INDEX)


def normaliser(n, documents: int, words: int):
    """m of a document of n terms."""
    return FLOOR + (SLOPE * n * documents) // words


def weight(documents: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


class Stratum:
    """Documents of equal m: for each term its postings, with the impact of each."""

    def __init__(self, m: int, doc_ids, ids, tfs, owners, weights):
        import numpy as np

        order = np.lexsort((-tfs, ids))
        self.ids, starts = np.unique(ids[order], return_index=True)
        self.ends = np.append(starts, len(ids))
        top = int(tfs.max()) if len(tfs) else 0
        # Once for each tf, however many postings have it.
        impact = np.array([SCALE * tf // (TF * tf + NORM * m) for tf in range(top + 1)], dtype="int64") if top < 1 << 16 else None
        each = impact[tfs[order]] if impact is not None else np.array([SCALE * int(t) // (TF * int(t) + NORM * m) for t in tfs[order]], dtype="int64")
        self.docs, self.gains = owners[order], each * weights[ids[order]]
        # Postings of a term fall by tf, so its first gain is its largest.
        self.best = self.gains[starts]
        self.doc_ids = doc_ids

    def bounds(self, wanted, repeats, starts):
        """Upper bound of the scores here, for each of many items whose terms stand one after another."""
        import numpy as np

        at = np.minimum(np.searchsorted(self.ids, wanted), len(self.ids) - 1)
        return np.add.reduceat(np.where(self.ids[at] == wanted, self.best[at] * repeats, 0), starts)

    def scores(self, wanted, repeats, exact: bool):
        """Score of each document of the stratum, and the items' terms with repeats."""
        import numpy as np

        at = np.minimum(np.searchsorted(self.ids, wanted), len(self.ids) - 1)
        here = self.ids[at] == wanted
        spans = [(self.ends[i], self.ends[i + 1], q) for i, q in zip(at[here], repeats[here])]
        if not spans:
            return np.zeros(len(self.doc_ids), dtype="int64")
        docs = np.concatenate([self.docs[a:b] for a, b, _ in spans])
        gains = np.concatenate([self.gains[a:b] * q for a, b, q in spans])
        if exact:
            out = np.zeros(len(self.doc_ids), dtype="int64")
            np.add.at(out, docs, gains)
            return out
        return np.bincount(docs, weights=gains, minlength=len(self.doc_ids)).astype("int64")


def _better(scores, ids, null):
    """Places in ranked order: score falling, then id rising, null ids last."""
    import numpy as np

    return np.lexsort((ids, null, -scores))


def search_strata(strata: list[Stratum], items: list, top: int = TOP) -> Iterator[tuple]:
    """(item key, score, doc_id) of the best ``top`` documents of these strata for each item.

    ``items``: (key, distinct term numbers, repeats), with a term at least. Strata are visited by falling bound.
    """
    import numpy as np

    if not strata or not items:
        return
    flat, starts = [np.concatenate([i[c] for i in items]) for c in (1, 2)], np.cumsum([0, *[len(i[1]) for i in items[:-1]]])
    above = np.stack([s.bounds(*flat, starts) for s in strata], axis=1)
    for (key, wanted, repeats), bounds in zip(items, above):
        exact = int(repeats.sum()) > EXACT_WORDS
        scores, ids, null = (np.zeros(0, dtype=t) for t in ("int64", "int64", bool))
        for k in np.argsort(-bounds, kind="stable"):
            # A document of equal score can still come first by its id.
            if bounds[k] <= 0 or (len(scores) == top and bounds[k] < scores[-1]):
                break
            got = strata[k].scores(wanted, repeats, exact)
            keep = np.flatnonzero(got >= max(1, scores[-1] if len(scores) == top else 1))
            if len(keep):
                own, own_null = strata[k].doc_ids
                scores = np.concatenate([scores, got[keep]])
                ids, null = np.concatenate([ids, own[keep]]), np.concatenate([null, own_null[keep]])
                order = _better(scores, ids, null)[:top]
                scores, ids, null = scores[order], ids[order], null[order]
        for s, i, x in zip(scores.tolist(), ids.tolist(), null.tolist()):
            yield key, s, None if x else i


class _DocIds:
    """Ids with a mark for null ones, cut and counted together."""

    def __init__(self, ids, null):
        self.ids, self.null = ids, null

    def __len__(self):
        return len(self.ids)

    def __iter__(self):
        return iter((self.ids, self.null))


def _dealt(index: DataFrame, documents: int, words: int, group_postings: int) -> DataFrame:
    """``index`` with ``cell``, the group of each document: of bounded postings, and whole strata where they fit."""
    held = index.withColumn("m", F.expr(f"{FLOOR} + ({SLOPE} * n * {documents}L) div {words}L"))
    # One row for each m that occurs, so at most as many as there are lengths of texts.
    sizes = held.groupBy("m").agg(F.sum(F.size("ids") + 1).alias("held"))
    before = F.sum("held").over(Window.orderBy("m")) - F.col("held")
    parts = sizes.select("m", F.floor(before / F.lit(group_postings)).alias("part"), F.ceil(F.col("held") / F.lit(group_postings)).alias("cuts"))
    cut = F.pmod(F.xxhash64("doc_id", "n", "ids"), F.col("cuts"))
    # A stratum that is cut has its groups to itself.
    whole = F.col("cuts") == 1
    cell = F.when(whole, F.xxhash64(F.lit(0), "part")).otherwise(F.xxhash64(F.lit(1), "m", cut))
    dealt = held.join(small(parts), "m").select(cell.alias("cell"), *index.columns)
    return dealt.repartition("cell").sortWithinPartitions("cell")


def _searched(index: DataFrame, items: list, weights: list[int], documents: int, words: int, group_postings: int, top: int) -> DataFrame:
    def search(batches: Iterator) -> Iterator:
        for _, table in runs(batches, "cell"):
            yield of_group(table.combine_chunks())

    def of_group(held):
        import numpy as np
        import pyarrow as pa

        column = lambda c: held.column(c).combine_chunks()
        doc_id = column("doc_id")
        null, ids = np.asarray(doc_id.is_null()), np.asarray(doc_id.fill_null(0))
        m = np.array([normaliser(int(n), documents, words) for n in column("n").to_pylist()], dtype="int64")
        per = np.asarray(column("ids").value_lengths()).astype("int64")
        owner = np.repeat(np.arange(len(m)), per)
        term, tf = np.asarray(column("ids").flatten()).astype("int64"), np.asarray(column("tfs").flatten()).astype("int64")
        order = np.argsort(m, kind="stable")
        place = np.empty(len(m), dtype="int64")
        strata, w = [], np.array(weights, dtype="int64")
        by_m = np.argsort(m[owner], kind="stable")
        values, first = np.unique(m[order], return_index=True)
        cut = np.searchsorted(m[owner][by_m], values)
        for k, value in enumerate(values.tolist()):
            rows = order[first[k] : first[k + 1] if k + 1 < len(first) else len(order)]
            post = by_m[cut[k] : cut[k + 1] if k + 1 < len(cut) else len(by_m)]
            if len(post):
                place[rows] = np.arange(len(rows))
                strata.append(Stratum(value, _DocIds(ids[rows], null[rows]), term[post], tf[post], place[owner[post]], w))
        asked = [(key, np.array(t, dtype="int64"), np.array(q, dtype="int64")) for key, t, q in items]
        out = list(search_strata(strata, asked, top))
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], type=pa.int64()) for i in range(3)], ["key", "score", "doc_id"])

    return _dealt(index, documents, words, group_postings).mapInArrow(search, "key long, score long, doc_id long")


def search(docs: DataFrame, items: DataFrame, top: int = TOP, block_terms: int = BLOCK_TERMS, group_postings: int = GROUP_POSTINGS) -> DataFrame:
    """item_id, rank, doc_id, score: the ``top`` documents of each row of ``items`` (item_id, text)."""
    spark, out = docs.sparkSession, None
    for block in _item_blocks(items, block_terms):
        counted = []
        vocabulary: dict[bytes, int] = {}
        for key, item_id, ws in block:
            repeats: dict[int, int] = {}
            for w in ws:
                t = vocabulary.setdefault(w, len(vocabulary))
                repeats[t] = repeats.get(t, 0) + 1
            counted.append((key, item_id, list(repeats), list(repeats.values())))
        index = saved(forward_index(docs, vocabulary), "index")
        documents, words = index.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
        if not documents or not vocabulary:
            continue
        df = dict(index.select(F.explode("ids").alias("t")).groupBy("t").count().collect())  # at most the block's terms
        weights = [weight(documents, df.get(t, 0)) for t in range(len(vocabulary))]
        asked = [(key, ts, qs) for key, _, ts, qs in counted if ts]
        found = _searched(index, asked, weights, documents, words, group_postings, top)
        ranked = found.withColumn("rank", F.row_number().over(
            Window.partitionBy("key").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last()))).filter(F.col("rank") <= top)
        names = spark.createDataFrame([(key, item_id) for key, item_id, _, _ in counted], f"key long, item_id {items.schema['item_id'].dataType.simpleString()}")
        got = ranked.join(F.broadcast(names), "key").select("item_id", "rank", "doc_id", "score")  # a block's items
        got = saved(got, "ranked")
        out = got if out is None else out.unionByName(got)
    if out is None:
        out = items.select("item_id", F.lit(0).alias("rank"), F.lit(0).cast("long").alias("doc_id"), F.lit(0).cast("long").alias("score")).limit(0)
    return out
