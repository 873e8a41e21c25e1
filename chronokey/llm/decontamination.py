"""Benchmark decontamination by a prefix-filtered set join, in DataFrame functions only.

A *window* is ``WINDOW`` consecutive words of a benchmark item; an item of fewer words,
but not none, is one window. A document is contaminated where a window's words stand
consecutively in it. Each window is a set of placed shingles (``SHINGLE`` consecutive
words; all words of a shorter window).

1. Matches: the shingles of the windows are looked up in all documents. Inside a document's
   own row a bitmap of their hashes passes the few places worth a join; those are exploded,
   each with the words around it that any window could need, and joined by hash.
2. Rarity: matches are counted per shingle. A window with a shingle that stands nowhere
   can't occur and is left out.
3. Prefix: containment asks for every shingle of a window, so a prefix of one is enough:
   its rarest. Matches are joined to these prefix shingles only.
4. Bounds: the place of the shingle in the window must leave room for the window's
   words before and behind it in the document.
5. Verification: the words of the document at that place equal the window's words.

Texts are read once and never shuffled; what moves is their matches, at most one row of
``2 * WINDOW`` words for each place, the verified places and a row of counts for each document. A row never carries its document's whole word array
past the explode. Shingles and prefixes whose rows are counted to be few enough are
broadcast, else the joins are ordinary shuffled ones on the shingle's hash. An item that
repeats an id belongs to that id; a window of several items is joined once and belongs to
all of them.

Words are those of :func:`words`; a null text has none. Rows that repeat are each
reported. An empty table gives no rows, an empty benchmark no hits. Item ids are compared
as strings, a null id as the empty string. Other columns, whatever their names, are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import saved, small, text_or_empty

# ---- fixed values: the window of the task, the word pattern of the task ----
WINDOW = 10
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
ANY_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"  # the same before A-Z are lower-cased
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# ---- end of fixed values ----

#: Words of a shingle, the rows of the join.
SHINGLE = 5

#: Bits of the bitmap of shingles, 32 kB; with more shingles than that it passes more places, with the same result.
MAX_BITS = 1 << 18

#: Prefix shingles are broadcast up to this many rows (about 200 bytes each).
PREFIX_ROWS = 100_000


def words(text: Column) -> Column:
    """The words of a text in which only A-Z are lower-cased."""
    return F.regexp_extract_all(F.translate(text, UPPER, LOWER), F.lit(WORD), F.lit(0))


def _as_written(text: Column) -> Column:
    """The words at the same places, in the letter case of the text.

    Lower-casing A-Z of a whole text with ``translate`` is slow. Documents are joined by the
    words lower-cased in all scripts, word by word: equal words are equal then too, so nothing
    is lost, and what the join finds is compared by A-Z alone.
    """
    return F.regexp_extract_all(text, F.lit(ANY_WORD), F.lit(0))


def _lowered(ws: Column) -> Column:
    return F.transform(ws, lambda w: F.translate(w, UPPER, LOWER))


def _word_hashes(ws: Column) -> Column:
    return F.transform(ws, lambda w: F.xxhash64(F.lower(w)))


def _hash(hashes: Column, at: Column, n: int) -> Column:
    """Hash of the ``n`` words from place ``at`` (from 0), given the words' hashes; words beyond the end count as null."""
    return F.xxhash64(F.lit(n), *[F.get(hashes, at + F.lit(i)) for i in range(n)])


def windows(items: DataFrame, window: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """(windows, owners) of ``items`` (item_id, text).

    windows: wid, len, ws (its words), one row for each different window. owners: wid, item_id.
    """
    ws = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), words(text_or_empty("text")).alias("ws"))
    ws = ws.filter(F.size("ws") > 0).withColumn("len", F.least(F.size("ws"), F.lit(window)))
    each = ws.select("item_id", "len", F.explode(F.transform(
        F.sequence(F.lit(1), F.size("ws") - F.col("len") + 1), lambda i: F.slice("ws", i, F.col("len")))).alias("ws"))
    # 256 bits of the words, which no word can contain a space of, stand for a window.
    owners = each.select(F.sha2(F.array_join("ws", " "), 256).alias("wid"), "len", "ws", "item_id").distinct()
    owners = saved(owners, "windows")
    return owners.select("wid", "len", "ws").distinct(), owners.select("wid", "item_id")


def shingles(wins: DataFrame, size: int = SHINGLE) -> DataFrame:
    """(wid, len, ws, at, k, sh): the placed shingles of each window; ``sh`` is the hash that documents are joined by."""
    k = F.least(F.col("len"), F.lit(size))
    placed = wins.withColumn("k", k).select("*", F.explode(F.sequence(F.lit(0), F.col("len") - F.col("k"))).alias("at"))
    sh = F.lit(None).cast("long")
    for n in range(size, 0, -1):
        sh = F.when(F.col("k") == n, _hash(F.col("hashes"), F.col("at"), n)).otherwise(sh)
    return placed.withColumn("hashes", _word_hashes(F.col("ws"))).withColumn("sh", sh).drop("hashes")


def _bitmap(placed: DataFrame) -> list[int]:
    """Bits of the shingles' hashes, as 64-bit words; at most ``MAX_BITS`` bits whatever the number of shingles."""
    n = min(MAX_BITS, max(64, 1 << (16 * placed.count()).bit_length())) // 64
    bits = placed.select(_slot(F.col("sh"), n).alias("w"), F.call_function("shiftleft", F.lit(1).cast("long"), _bit(F.col("sh"))).alias("b"))
    held = dict(bits.groupBy("w").agg(F.bit_or("b")).collect())
    return [held.get(i, 0) for i in range(n)]


def _bit(sh: Column) -> Column:
    return sh.bitwiseAND(F.lit(63)).cast("int")


def _slot(sh: Column, n: int) -> Column:
    """``n`` is a power of two."""
    return F.shiftright(sh, 6).bitwiseAND(F.lit(n - 1)).cast("int")


def _matches(docs: DataFrame, placed: DataFrame, lengths: list[int], window: int) -> DataFrame:
    """doc_id, mark, n, at, sh, from, around: each place of the documents where a shingle of ``placed`` stands by its hash.

    ``around`` has the words from place ``from`` on as they are written. Each document has a
    further row with its number of words ``n`` and null ``at``.
    """
    bitmap = _bitmap(placed)
    held = F.array(*[F.lit(x).cast("long") for x in bitmap])
    back, reach = F.lit(window), F.lit(2 * window)
    split = docs.select("doc_id", F.md5("text").alias("mark"), _as_written(F.col("text")).alias("written"))
    split = split.withColumn("hashes", _word_hashes(F.col("written")))

    def found(n: int) -> Column:
        every = F.transform("hashes", lambda h, i: F.struct(i.alias("at"), _hash(F.col("hashes"), i, n).alias("sh")))
        seen = F.filter(every, lambda x: F.getbit(F.get(held, _slot(x["sh"], len(bitmap))), _bit(x["sh"])) == 1)
        return F.transform(seen, lambda x: F.struct(
            x["at"].alias("at"), x["sh"].alias("sh"), F.greatest(x["at"] - back, F.lit(0)).alias("from"),
            F.slice(F.col("written"), F.greatest(x["at"] - back, F.lit(0)) + 1, reach).alias("around")))

    own = F.array(F.struct(F.lit(None).cast("int").alias("at"), F.lit(None).cast("long").alias("sh"), F.lit(None).cast("int").alias("from"),
                           F.lit(None).cast("array<string>").alias("around")))
    each = split.select("doc_id", "mark", F.size("written").alias("n"), F.explode(F.concat(own, *[found(n) for n in lengths])).alias("x"))
    known = small(placed.select("sh", F.lit(True).alias("known")).distinct())
    return each.select("doc_id", "mark", "n", "x.*").join(known, "sh", "left").filter("at is null or known").drop("known")


def occurrences(docs: DataFrame, wins: DataFrame, window: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """(rows, places) of ``docs`` (doc_id, text).

    rows: doc_id, mark, n (words) of every row. places: doc_id, mark, wid, start, len of every
    place where a window's words stand; rows alike in id and text repeat them.
    """
    placed = saved(shingles(wins), "shingles")
    lengths = sorted(r[0] for r in placed.select("k").distinct().collect())  # at most SHINGLE numbers
    matches = saved(_matches(docs, placed, lengths, window), "matches")
    rows, matches = matches.filter("at is null").select("doc_id", "mark", "n"), matches.filter("at is not null")
    # The rarest shingle of each window, if all of them occur; ties by place.
    counts = matches.groupBy("sh").agg(F.count(F.lit(1)).alias("df"))
    ranked = placed.join(counts, "sh", "left").groupBy("wid", "len", "ws").agg(
        F.min(F.struct(F.coalesce("df", F.lit(0)).alias("df"), "at", "sh")).alias("first"))
    prefix = saved(ranked.filter(F.col("first.df") > 0).select(
        "wid", "len", "ws", F.col("first.at").alias("off"), F.col("first.sh").alias("sh")), "prefix")
    start = F.col("at") - F.col("off")
    found = matches.join(small(prefix, PREFIX_ROWS), "sh").filter((start >= 0) & (start + F.col("len") <= F.col("n")))
    found = found.filter(_lowered(F.slice("around", start - F.col("from") + 1, F.col("len"))) == F.col("ws"))
    return rows, found.select("doc_id", "mark", "wid", start.alias("start"), "len")


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row for each row of ``docs`` (doc_id, text): doc_id, n_words, n_hit, n_items, items_sha256, contaminated, item_ids.

    ``n_hit`` counts the words inside any occurrence of a window, ``n_items`` the items with
    windows that occur, ``item_ids`` lists them, sorted as strings. A document is known by its
    id and the 128-bit digest of its text; rows equal in both have equal results.
    """
    wins, owners = windows(items, window)
    rows, places = occurrences(docs.select("doc_id", text_or_empty("text").alias("text")), wins, window)
    key = F.struct("doc_id", "mark").alias("key")
    hits = saved(places.select(key, "wid", "start", "len").distinct(), "hits")
    # Words covered by the union of the places, taken in order: each adds what lies beyond those before it.
    covered = F.aggregate(
        F.array_sort(F.collect_set(F.struct("start", "len"))),
        F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n")),
        lambda acc, p: F.struct(
            F.greatest(acc["end"], p["start"] + p["len"]).alias("end"),
            (acc["n"] + F.greatest(F.lit(0), p["start"] + p["len"] - F.greatest(acc["end"], p["start"])).cast("long")).alias("n")),
        lambda acc: acc["n"])
    spans = hits.groupBy("key").agg(covered.alias("n_hit"))
    named = hits.select("key", "wid").distinct().join(small(owners), "wid").groupBy("key").agg(
        F.array_sort(F.collect_set("item_id")).alias("item_ids"))
    found = spans.join(named, "key")
    ids = F.coalesce("item_ids", F.array().cast("array<string>"))
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return rows.select(key, F.col("n").cast("long").alias("n_words")).join(found, "key", "left").select(
        F.col("key.doc_id").alias("doc_id"), "n_words", n_hit.alias("n_hit"), F.size(ids).cast("long").alias("n_items"),
        F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"), ids.alias("item_ids"))
