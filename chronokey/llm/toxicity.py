"""Toxicity scores from a weighted finite-state pattern grammar.

Words become symbols (insult, threat, target, negation, reported speech, other). Three
transducers are composed and run over each clause: negation marks what stands in
its scope, reported speech marks what follows a verb of saying, and the target
transducer joins an insult or threat with a target in the same clause. The
clause's matches (kind and marks), not isolated words, carry weights.

Insult words and stems, and the weights, are learned from labels: at most SAMPLE
labelled rows (those with the smallest hash of their id) whose
crc32(id as text) mod 5 is not 0. A candidate counts once per context (words
before and after it), so copies of a text don't make its words look toxic. Function
words (targets, negation, saying, threats) are fixed lists.

Cases: a null text is empty and gets the score of a text without matches. A null id
counts as held out. Rows without a label, or with a null one, are scored but never
learned from; of several labels of an id the largest counts. Without any positive
label every score is 0. Repeated rows give repeated results; an empty table gives an
empty result. Only the id and the text are read.
"""

from __future__ import annotations

import functools
import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import packed, text_or_empty

#: Labelled rows that are learned from, candidates tested, least contexts of one, and lexicon entries.
SAMPLE, CANDIDATES, CONTEXTS, ENTRIES = 20_000, 20_000, 6, 500
STEMS = range(3, 9)
#: Least share of positive rows of an entry, chance at most of so many among all rows, and the ridge of the weights.
PURITY, CHANCE, RIDGE = 0.8, 1e-5, 0.01

# Function words of the grammar (English, German, French, Spanish).
TARGETS = "you your you're he she they them him her us we people du dich dir ihr euch sie er tu toi te vous il elle ils elles usted ustedes él ella ellos".split()
NEGATIONS = "not no never isn't aren't don't doesn't without nicht kein keine nie ohne pas jamais sans nunca jamás sin tampoco".split()
SAYING = "said says say told called calls wrote claims claimed quoted sagte sagt schrieb nannte dit disait appelle écrit dijo dice llamó escribió".split()
THREATS = "kill hurt destroy shoot burn beat töten sterben verbrennen tuer mourir frapper brûler matar morir quemar golpear".split()
TOKEN = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)?|[.!?;:\n]")

INSULT, THREAT, TARGET, NEGATION, SAID, WORD, END = "insult", "threat", "target", "negation", "said", "word", "end"
FIXED = {**dict.fromkeys(TARGETS, TARGET), **dict.fromkeys(NEGATIONS, NEGATION), **dict.fromkeys(SAYING, SAID), **dict.fromkeys(THREATS, THREAT)}
SCOPE = 3


# Transducers: (state, symbol) -> (state, symbols out). A match is (kind, marks).
def negation(state: int, symbol):
    if symbol == END:
        return 0, (END,)
    if symbol == NEGATION:
        return SCOPE, (WORD,)
    if symbol in (INSULT, THREAT):
        return max(0, state - 1), ((symbol, "n" if state else ""),)
    return max(0, state - 1), (symbol,)


def reported(state: int, symbol):
    if symbol == END:
        return 0, (END,)
    if symbol == SAID:
        return 1, (WORD,)
    if isinstance(symbol, tuple):
        return state, ((symbol[0], symbol[1] + "r" * state),)
    return state, (symbol,)


def directed(state: tuple, symbol):
    """State: whether the clause has a target, and the matches that still wait for one."""
    seen, waiting = state
    if symbol == END:
        return (False, ()), tuple((k, m) for k, m in waiting)
    if symbol == TARGET:
        return (True, ()), tuple((k, m + "t") for k, m in waiting)
    if isinstance(symbol, tuple):
        return ((True, ()), ((symbol[0], symbol[1] + "t"),)) if seen else ((False, (*waiting, symbol)), ())
    return state, ()


START = (0, 0, (False, ()))


@functools.lru_cache(100_000)
def composed(state: tuple, symbol) -> tuple[tuple, tuple]:
    """One step of negation, then reported speech, then targets."""
    n, (one,) = negation(state[0], symbol)
    r, (two,) = reported(state[1], one)
    d, out = directed(state[2], two)
    return (n, r, d), out


KINDS = [(k, m) for k in (INSULT, THREAT) for m in ("", "t", "n", "nt", "r", "rt", "nr", "nrt")]
FEATURES = len(KINDS) + 2
#: Weights that the fit starts from and is drawn to, by marks (t: target, n: negated, r: reported), then clauses, insults, bias.
PRIOR = {INSULT: dict(zip(("", "t", "n", "nt", "r", "rt", "nr", "nrt"), (1.0, 1.5, 0.3, 0.5, 0.3, 0.5, 0.0, 0.0), strict=True)),
         THREAT: dict(zip(("", "t", "n", "nt", "r", "rt", "nr", "nrt"), (0.0, 0.5, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0), strict=True))}


class Lexicon:
    def __init__(self, entries: list[str]):
        """Entries are words, or stems that end in ``*``."""
        self.words = {e for e in entries if not e.endswith("*")}
        self.stems = {e[:-1] for e in entries if e.endswith("*")}
        self.sizes = sorted({len(s) for s in self.stems})
        self.known: dict[str, str] = {}

    def symbol(self, word: str) -> str:
        found = self.known.get(word)
        if found is None:
            if word in self.words or any(word[:n] in self.stems for n in self.sizes if len(word) >= n):
                found = INSULT
            else:
                found = FIXED.get(word) or (END if not word[0].isalpha() else WORD)
            if len(self.known) > 500_000:
                self.known.clear()
            self.known[word] = found
        return found

    def matches(self, text: str) -> tuple[Counter, int, int]:
        """(kind, marks) of all clauses, the number of clauses with an insult, and of different insults."""
        symbols = list(map(self.symbol, words := TOKEN.findall(text.lower())))
        found, clauses, which = Counter(), 0, set()
        if INSULT not in symbols and THREAT not in symbols:
            return found, 0, 0
        state, hit, plain = START, False, 0
        for word, s in zip([*words, "."], [*symbols, END], strict=True):
            if s == WORD:  # only the scope of a negation is counted down
                plain += 1
                continue
            for _ in range(min(plain, SCOPE) if state[0] else 0):
                state, _ = composed(state, WORD)
            plain = 0
            state, out = composed(state, s)
            if len(state[2][1]) > 50:  # a clause without end: what waits is given out, the state table stays small
                out, state = (*out, *state[2][1]), (*state[:2], (False, ()))
            found.update(out)
            if s == INSULT:
                hit = True
                which.add(word)
            if s == END:
                clauses += hit
                hit = False
        return found, clauses, len(which)

    def features(self, text: str) -> list[float]:
        found, clauses, which = self.matches(text)
        marks = [(k, "".join(sorted(m))) for k, m in KINDS]
        by = Counter()
        for (k, m), n in found.items():
            by[(k, "".join(sorted(m)))] += n
        return [math.log1p(by[x]) for x in marks] + [math.log1p(clauses), math.log1p(which)]


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def training_rows(texts: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(doc_id, t, y) of at most ``sample`` labelled rows that are not held out."""
    chosen = (labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
              .groupBy("doc_id").agg(F.max("toxic").alias("y")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample))
    return texts.join(F.broadcast(chosen.select(F.col("doc_id").alias("k"), "y")), F.col("doc_id") == F.col("k")).select("doc_id", "t", "y")


def units(word: str) -> Iterator[str]:
    yield word
    for n in STEMS:
        if len(word) >= n:
            yield word[:n] + "*"


def learn_lexicon(train: DataFrame) -> list[str]:
    """Words and stems that mark positive labels; the driver gets at most CANDIDATES rows."""

    def contexts(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for b in batches:
            rows = set()
            for text in b.column(0).to_pylist():
                words = ["", *TOKEN.findall(text.lower()), ""]
                for before, w, after in zip(words, words[1:], words[2:]):
                    if w and w[0].isalpha() and w not in FIXED:
                        c = hash_of(f"{before} {after}")
                        rows.update((u, c) for u in units(w))
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int64())], ["unit", "context"])

    def hash_of(s: str) -> int:
        import xxhash

        return xxhash.xxh64_intdigest(s) - (1 << 63)

    positive, negative = train.filter("y = 1").select("t"), train.filter("y = 0").select("t")
    found = (positive.mapInArrow(contexts, "unit string, context long").distinct().groupBy("unit").agg(F.count("*").alias("n"))
             .filter(F.col("n") >= CONTEXTS).orderBy(F.desc("n"), "unit").limit(CANDIDATES).collect())
    spread = {r["unit"]: r["n"] for r in found}

    def seen_in(batches: Iterator) -> Iterator:
        import pyarrow as pa

        seen: Counter = Counter()
        for b in batches:
            for text in b.column(0).to_pylist():
                seen[""] += 1
                seen.update({u for w in set(TOKEN.findall(text.lower())) for u in units(w) if u in spread})
        yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], ["unit", "n"])

    def counts(rows: DataFrame) -> dict[str, int]:
        total = rows.mapInArrow(seen_in, "unit string, n long").groupBy("unit").agg(F.sum("n").alias("n")).collect()
        return {r["unit"]: r["n"] for r in total}

    pos, neg = counts(positive), counts(negative)
    n_pos, n_neg = pos.get("", 0), neg.get("", 0)
    good = {}
    for u, c in spread.items():
        p, n = min(pos.get(u, 0), c), neg.get(u, 0)
        if p < PURITY * (p + n):
            continue
        # Chernoff bound of p positive rows among p + n, by the share of positive rows.
        share, base = p / (p + n), n_pos / max(1, n_pos + n_neg)
        surprise = share * math.log(share / base) + ((1 - share) * math.log((1 - share) / (1 - base)) if n else 0.0) if share > base else 0.0
        if (p + n) * surprise >= -math.log(CHANCE):
            good[u] = p
    # Of nested entries with the same support the longest stays; entries inside a wider one go.
    chosen: list[str] = []
    for u in sorted(good, key=lambda u: (-good[u], -len(u.rstrip("*")), u.endswith("*"), u)):
        stem = u.rstrip("*")
        wider = [c for c in chosen if c.endswith("*") and stem.startswith(c[:-1])]
        longer = [c for c in chosen if u.endswith("*") and c.rstrip("*").startswith(stem) and good[u] <= 1.1 * good[c] + 2]
        if not wider and not longer:
            chosen.append(u)
    return chosen[:ENTRIES]


def fit(x: np.ndarray, y: np.ndarray, ridge: float = RIDGE) -> np.ndarray:
    """Logistic regression by Newton steps; the last weight is the bias."""
    x = np.hstack([x, np.ones((len(x), 1))])
    prior = np.array([*(PRIOR[k][m] for k, m in KINDS), 0.5, 0.5, -3.0])
    w = prior.copy()
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-4
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (p - y) / len(y) + penalty * (w - prior) / 10
        hess = (x * (p * (1 - p))[:, None]).T @ x / len(y) + np.diag(penalty / 10)
        step = np.linalg.solve(hess, grad)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


class Model:
    def __init__(self, entries: list[str], weights: np.ndarray):
        self.entries, self.weights = entries, weights

    def scores(self, lexicon: Lexicon, texts: list[str]) -> np.ndarray:
        x = np.array([lexicon.features(t) for t in texts], float).reshape(len(texts), FEATURES)
        return 1 / (1 + np.exp(-np.clip(x @ self.weights[:-1] + self.weights[-1], -30, 30)))


def train(texts: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """``texts``: doc_id, t; ``labels``: doc_id, toxic. The driver gets at most ``sample`` feature rows."""
    rows = training_rows(texts, labels, sample)
    entries = learn_lexicon(rows)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        lexicon = Lexicon(entries)
        for b in batches:
            x = [lexicon.features(t) for t in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(1), pa.array(x, pa.list_(pa.float64()))], ["y", "x"])

    got = rows.select("t", F.col("y").cast("int").alias("y")).mapInArrow(run, "y int, x array<double>").collect()
    y = np.array([r["y"] for r in got], float)
    if not len(y) or not y.any():
        return Model(entries, np.append(np.zeros(FEATURES), -30.0))
    return Model(entries, fit(np.array([r["x"] for r in got]), y))


def score_texts(rows: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    """``rows`` with a text column ``t``: the columns ``keep`` and ``score``."""
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.select(*keep).schema)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        lexicon = Lexicon(model.entries)
        for b in batches:
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(model.scores(lexicon, b.column(len(keep)).to_pylist()), pa.float64())],
                                             [*keep, "score"])

    return rows.select(*keep, "t").mapInArrow(run, f"{schema}, score double")


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, score, predicted."""
    texts = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("t"))
    model = train(texts, labels, sample)
    scored = score_texts(texts, model, ["doc_id"])
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> DataFrame:
    """``docs`` without the rows whose text scores 0.5 or more."""
    texts = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("t"))
    model = train(texts, labels, sample)

    @F.pandas_udf("double")
    def score(t):
        import pandas as pd

        lexicon = functools.lru_cache(1)(lambda: Lexicon(model.entries))()
        return pd.Series(model.scores(lexicon, t.tolist()))

    rows = packed(docs)
    return rows.filter(score(text_or_empty(F.col(f"row.{text_col}"))) < 0.5).select("row.*")
