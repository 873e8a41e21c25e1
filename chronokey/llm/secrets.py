"""Secret scans: fixed patterns, and strings that look random to character Markov models.

Two first-order character models are trained from labelled samples: random strings
(the values that the fixed patterns find) and ordinary identifiers (other runs of letters, digits,
``_`` and ``-`` that are too short to be judged or occur more than once), both over all documents. Digits count as one character, so that a
number is judged by its length and surroundings. A run of token characters
whose log-likelihood ratio per character passes a threshold is a span of kind
``markov``, unless it overlaps a span of the fixed patterns. All of it is
built-in column functions: one projection per document, and for the identifiers a count of distinct
words, aggregated before it is shuffled. Texts aren't shuffled.

Cases: a null text is empty. A character that no labelled random string has is no evidence, so without
any such string (also: an empty table) no span passes. Repeated rows give repeated
results. Only the id and the text are read, so other columns never clash.
Positions are code points, end exclusive.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_or_empty

# The patterns of the base scan, in the order of their kinds.
ASSIGN = (r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
KINDS = ("assign", "access", "hex", "markov")
#: Candidates of the Markov models, and identifiers that train one of them.
SHORTEST = 16
TOKEN = rf"[A-Za-z0-9+/_=-]{{{SHORTEST},}}"
WORD = r"[A-Za-z0-9_-]{4,}"
#: Log-likelihood ratio a candidate needs, per transition and in all.
PER_CHAR, IN_ALL = 0.5, 10.0
#: Smoothing count, and the most that one transition says, so that a rare one does not decide alone.
SMOOTH, MOST = 0.1, 3.0
#: Elements of a block of running sums, and characters of a page of the overlap test.
BLOCK, PAGE = 256, 4096


def offsets(lengths: Column) -> Column:
    """Sum of the lengths before each, in blocks: an array that grows by one element at a time
    costs the square of its size, so it grows to ``BLOCK`` only."""
    def running(xs: Column, first: Column) -> Column:
        zero = F.struct(first.alias("at"), F.array().cast("array<int>").alias("out"))
        return F.aggregate(xs, zero, lambda acc, x: F.struct(
            (acc["at"] + x).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out")))["out"]

    count = F.floor((F.size(lengths) + F.lit(BLOCK - 1)) / F.lit(BLOCK)).cast("int")
    blocks = F.filter(F.transform(F.sequence(F.lit(0), count), lambda b: F.slice(lengths, b * BLOCK + 1, BLOCK)), lambda x: F.size(x) > 0)
    firsts = running(F.transform(blocks, lambda x: F.aggregate(x, F.lit(0), lambda acc, y: acc + y)), F.lit(0))
    return F.flatten(F.zip_with(blocks, firsts, running))


def spans_of(text: Column, pattern: str, kind: str) -> Column:
    """Array of (start, end, kind order, text) of all leftmost, non-overlapping matches."""
    order = KINDS.index(kind)
    empty = F.array().cast("array<struct<start:int,end:int,kind:int,value:string>>")

    def placed(pairs: Column) -> Column:
        """``pairs``: each match with the text between it and the one before."""
        before = offsets(F.transform(pairs, lambda p: F.length(p["gap"]) + F.length(p["found"])))
        return F.zip_with(pairs, before, lambda p, at: F.struct(
            (at + F.length(p["gap"])).alias("start"), (at + F.length(p["gap"]) + F.length(p["found"])).alias("end"),
            F.lit(order).alias("kind"), p["found"].alias("value")))

    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    pairs = F.zip_with(found, F.slice(gaps, 1, F.size(found)), lambda m, g: F.struct(m.alias("found"), g.alias("gap")))
    return F.when(F.rlike(text, F.lit(pattern)), _once(pairs, placed)).otherwise(empty)


def _once(value: Column, use) -> Column:
    """``use(value)`` with the value worked out once, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def base_spans(text: Column) -> Column:
    value = lambda s: F.regexp_extract(s["value"], ASSIGN, 2)
    assign = F.filter(spans_of(text, ASSIGN, "assign"), lambda s: F.length(value(s)) >= 12)
    return F.concat(assign, spans_of(text, ACCESS, "access"), spans_of(text, HEX, "hex"))


def joined(spans: Column) -> Column:
    """kind:start:end, by start, then kind, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    keyed = F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))
    return F.array_join(F.transform(F.array_sort(keyed), lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def steps(s: Column) -> Column:
    """128 x (character) + (next character) along an ASCII string, of which it splits the characters once; all digits are 0."""
    plain = F.translate(s, "123456789", "000000000")
    codes = F.transform(F.filter(F.split(plain, ""), lambda c: c != ""), lambda c: F.ascii(c))
    return _once(codes, lambda c: F.zip_with(F.slice(c, 1, F.size(c) - 1), F.slice(c, 2, F.size(c)), lambda x, y: x * 128 + y))


def transitions(strings: DataFrame) -> dict[tuple[int, int], int]:
    """Counts of (character, next character) over the column ``s``, each ``n`` times; at most 128 x 128 rows reach the driver."""
    rows = (strings.filter(F.length("s") > 1).select(F.explode(steps(F.col("s"))).alias("step"), "n")
            .filter("step between 0 and 16383").groupBy("step").agg(F.sum("n").alias("n")).collect())
    return {divmod(r["step"], 128): r["n"] for r in rows}


def log_ratios(random: dict[tuple[int, int], int], plain: dict[tuple[int, int], int]) -> list[float]:
    """128 x 128 log-likelihood ratios of a transition, random against plain, smoothed; 0 after a character
    that no random string has."""
    out = []
    sums = [[sum(m.get((a, b), 0) for b in range(128)) for a in range(128)] for m in (random, plain)]
    for a in range(128):
        for b in range(128):
            p, q = ((m.get((a, b), 0) + SMOOTH) / (s[a] + SMOOTH * 128) for m, s in zip((random, plain), sums, strict=True))
            out.append(round(max(-MOST, min(MOST, math.log(p / q))), 4) if sums[0][a] else 0.0)
    return out


def train(docs: DataFrame, base: DataFrame) -> list[float]:
    """Fit both models. ``docs`` has doc_id and t, ``base`` the column ``spans`` of all documents."""
    value = F.when(F.col("x.kind") == 0, F.regexp_extract(F.col("x.value"), ASSIGN, 2)).otherwise(F.col("x.value"))
    random = base.filter(F.size("spans") > 0).select(F.explode("spans").alias("x")).select(value.alias("s"), F.lit(1).alias("n"))
    rest = F.regexp_replace("t", F.lit(f"{ASSIGN}|{ACCESS}|{HEX}"), F.lit(" "))
    # Equal words are counted before anything moves; the rows that move are distinct words of a task.
    plain = (docs.select(F.explode(F.regexp_extract_all(rest, F.lit(WORD), F.lit(0))).alias("s"))
             .groupBy("s").agg(F.count("*").alias("n")).filter((F.length("s") < SHORTEST) | (F.col("n") > 1)))
    return log_ratios(transitions(random), transitions(plain))


def clear_of(spans: Column, others: Column) -> Column:
    """The ``spans`` that overlap none of ``others``. Others are dealt to pages of ``PAGE`` characters first,
    so that a span looks at those of its own pages only."""
    page = lambda at: F.floor(at / F.lit(PAGE)).cast("int")
    last = F.aggregate(others, F.lit(0), lambda acc, o: F.greatest(acc, page(o["end"])))
    pages = F.transform(F.sequence(F.lit(0), last), lambda p: F.filter(
        others, lambda o: (o["start"] < (p + 1) * PAGE) & (o["end"] > p * PAGE)))

    def apart(pg: Column) -> Column:
        def hit(c: Column, p: Column) -> Column:
            return F.coalesce(F.exists(F.get(pg, p), lambda o: (o["start"] < c["end"]) & (o["end"] > c["start"])), F.lit(False))

        def between(c: Column) -> Column:
            inner = F.slice(pg, page(c["start"]) + 2, F.greatest(page(c["end"] - 1) - page(c["start"]) - 1, F.lit(0)))
            return F.exists(inner, lambda x: F.size(x) > 0)

        return F.filter(spans, lambda c: ~(hit(c, page(c["start"])) | hit(c, page(c["end"] - 1)) | between(c)))

    return F.when((F.size(spans) > 0) & (F.size(others) > 0), _once(pages, apart)).otherwise(spans)


def markov_spans(text: Column, base: Column, ratios: list[float]) -> Column:
    table = F.from_json(F.lit(json.dumps(ratios)), "array<double>")

    def score(s: Column) -> Column:
        return F.aggregate(steps(s), F.lit(0.0), lambda acc, x: acc + F.get(table, x))

    found = _once(spans_of(text, TOKEN, "markov"), lambda c: clear_of(c, base))
    return F.filter(found, lambda c: score(c["value"]) >= F.greatest(
        F.lit(IN_ALL), F.lit(PER_CHAR) * (F.length(c["value"]) - 1)))


def secret_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, base (spans of the fixed patterns), markov (spans of the models)."""
    texts = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("t"))
    base = texts.select("doc_id", "t", base_spans(F.col("t")).alias("spans"))
    ratios = train(texts, base)
    return base.select("doc_id", F.col("spans").alias("base"), markov_spans(F.col("t"), F.col("spans"), ratios).alias("markov"))


def secret_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The digest columns of a scan: counts per kind, base_sha256 and the joined spans."""
    found = secret_scan(docs, id_col, text_col)
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == KINDS.index(k))).cast("long")
    return found.select("doc_id", *[count(k).alias(f"n_{k}") for k in KINDS[:3]],
                        F.sha2(joined(F.col("base")).cast("binary"), 256).alias("base_sha256"),
                        joined(F.concat("base", "markov")).alias("spans"), F.size("markov").cast("long").alias("n_markov"))
