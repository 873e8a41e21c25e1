"""BPE encoding that reuses content-defined chunks, and decoding.

A rolling hash over a window of code points cuts texts into chunks, so equal passages
give equal chunks wherever they stand. Chunks that occur more than once in the
corpus are encoded once, at their first place, and their ids are joined to all
their places. What is left of each text is encoded in place. Each join between
pieces is then repaired: a window around it is encoded anew, from and to places that no
pre-token spans in any script (SAFE). Its first and last ids must be those of the pieces there;
a window that disagrees grows and is encoded again until all agree. At last the
ids must decode to the text: a text with special tokens' strings, or with ids that a collision
of keys brought in, is encoded whole. A text without safe places is one window.

Only hashes, shared chunks and one copy of each text (compressed) move; the
number of places of a chunk is not limited.

Cases: a null text is empty and has no ids. Repeated rows give repeated results. Null
ids are ordinary. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import bisect
import re
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved, text_or_empty

#: Code points of the rolling hash's window, mean and least size of a chunk.
WINDOW, MEAN, LEAST = 16, 256, 64
#: Places that every pre-tokenisation cuts: a space between letters or digits of any script, the end of a
#: line after one, CJK punctuation after a kana, ideograph or Hangul syllable.
SAFE = re.compile(r"(?<=[^\W_]) (?=[^\W_])|(?<=[^\W_])(?=\n)|(?<=[\u3041-\u3096\u30a1-\u30fa\u4e00-\u9fa5\uac00-\ud7a3])(?=[\u3001\u3002\uff01\uff0c\uff1a\uff1b\uff1f])")


def chunks_of(text: str, window: int = WINDOW, mean: int = MEAN, least: int = LEAST):
    """(starts, ends, hashes) of a text's chunks; ``mean`` is a power of two."""
    import numpy as np

    from .bpe import Prefix, code_points

    cps = code_points(text)
    sums = Prefix(cps)
    at = np.arange(window, len(cps))
    rolled = sums.of(at - window, at) * np.uint64(0xD6E8FEB86659FD93) >> np.uint64(40)
    cuts, last = [], 0
    for c in at[(rolled & np.uint64(mean - 1)) == 0].tolist():
        if c - last >= least:
            cuts.append(c)
            last = c
    start = np.array([0, *cuts], np.int64)
    end = np.array([*cuts, len(cps)], np.int64)
    return start, end, sums.of(start, end).view(np.int64)


def chunk_rows(texts: DataFrame) -> DataFrame:
    """(th, off, len, h): the chunks of every text."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            for a in range(0, batch.num_rows, 256):
                cut = [chunks_of(t) for t in batch.column(1).slice(a, 256).to_pylist()]
                keys = np.repeat(batch.column(0).slice(a, 256).to_numpy(), [len(c[0]) for c in cut])
                start, end, h = (np.concatenate([c[i] for c in cut]) for i in range(3))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys), pa.array(start.astype(np.int32)), pa.array((end - start).astype(np.int32)), pa.array(h)],
                    ["th", "off", "len", "h"])

    return texts.select("th", "t").mapInArrow(run, "th long not null, off int, len int, h long not null")


def keyed_texts(texts: DataFrame) -> DataFrame:
    """(doc_id, th, z): texts compressed, with their key.

    The key is declared not null, so that no filter is put below one of the two joins
    that use this table, and both read one exchange.
    """
    kind = dict(texts.dtypes)["doc_id"]

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        import zstandard

        press = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.array([press.compress(t.encode()) for t in batch.column(2).to_pylist()], pa.binary())],
                ["doc_id", "th", "z"])

    return texts.select("doc_id", "th", "t").mapInArrow(run, f"doc_id {kind}, th long not null, z binary")


def _text(z: bytes) -> str:
    import zstandard

    return zstandard.ZstdDecompressor().decompress(z).decode()


def encode_owned(rows: DataFrame, vocabulary: str) -> DataFrame:
    """(h, ids) of the chunks that a text owns; rows have doc_id, z and own (the id only keeps the columns
    of the exchange that the other join reads too)."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        from .bpe import encoder

        enc = encoder(vocabulary)
        for batch in batches:
            for a in range(0, batch.num_rows, 256):
                b = batch.slice(a, 256)
                found = [(c["h"], t[c["off"]:c["off"] + c["len"]]) for t, own in
                         zip(map(_text, b.column(1).to_pylist()), b.column(2).to_pylist(), strict=True) for c in own]
                ids = enc.encode([f[1] for f in found])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([f[0] for f in found], pa.int64()), pa.array([x.astype(enc.narrow).tobytes() for x in ids], pa.binary())], ["h", "ids"])

    return rows.select("doc_id", "z", "own").mapInArrow(run, "h long not null, ids binary")


class Pieces:
    """Ids of a text in pieces, and the windows that repair their joins."""

    def __init__(self, text: str, refs: list[dict], sizes, kind: str = "<u4"):
        """``refs``: encoded chunks (off, len, ids) of the text; the stretches between them are still to encode.
        ``sizes``: bytes of each token."""
        import numpy as np

        self.text, self.sizes = text, sizes
        self.bounds: list[tuple[int, int]] = []
        self.ids: list = []
        self.todo: list[int] = []
        self.ends: dict = {}
        self.made: dict = {}  # ids of the windows encoded so far
        at = 0
        for r in [*sorted(refs, key=lambda r: r["off"]), None]:
            off = len(text) if r is None else r["off"]
            if off > at:
                self.todo.append(len(self.bounds))
                self.bounds.append((at, off))
                self.ids.append(None)
            if r is not None:
                self.bounds.append((off, off + r["len"]))
                self.ids.append(np.frombuffer(r["ids"], kind).astype(np.int32))
                at = off + r["len"]
        self.starts = [s for s, _ in self.bounds]
        self.spans = self.windows()

    def before(self, at: int, low: int = 0) -> int:
        """The last safe place before ``at`` and not before ``low``; ``low`` if there is none."""
        reach = 64
        while at > low:
            left = max(low, at - reach)
            found = [m.start() for m in SAFE.finditer(self.text, left, at)]
            if found:
                return found[-1]
            if left == low:
                break
            reach *= 4
        return low

    def after(self, at: int) -> int:
        """The first safe place from ``at`` on, else the end of the text."""
        found = SAFE.search(self.text, at)
        return found.start() if found else len(self.text)

    def windows(self) -> list[tuple[int, int]]:
        """A (start, end) around each join, in order and apart: from the second safe place before it to the second
        behind it, so that a pre-token on either side lies in the window and in the piece, and can be compared."""
        out: list[tuple[int, int]] = []
        for _, join in self.bounds[:-1]:
            low = out[-1][1] if out else 0
            if join < low:
                continue
            start = self.before(self.before(join, low), low)
            end = self.after(self.after(join + 1) + 1)
            if out and start <= low:
                start = out.pop()[0]
            out.append((start, end))
        return out

    def cut(self, k: int, at: int) -> int | None:
        """Tokens of piece k before place ``at`` of the text; None if a token spans it."""
        import numpy as np

        if k not in self.ends:
            self.ends[k] = np.concatenate([[0], np.cumsum(self.sizes[self.ids[k]])])
        size = len(self.text[self.bounds[k][0]:at].encode())
        i = int(np.searchsorted(self.ends[k], size))
        return i if i < len(self.ends[k]) and self.ends[k][i] == size else None

    def differs(self, span: tuple[int, int]) -> tuple[bool, bool]:
        """Whether the first and the last id of a window differ from the pieces' ids there."""
        (a, b), ids = span, self.made[span]
        left = right = False
        if a > 0:
            k = bisect.bisect_right(self.starts, a) - 1
            i = self.cut(k, a)
            left = i is None or i >= len(self.ids[k]) or self.ids[k][i] != ids[0]
        if b < len(self.text):
            k = bisect.bisect_right(self.starts, b) - 1
            j = self.cut(k, b)
            right = not j or self.ids[k][j - 1] != ids[-1]
        return left, right

    def widen(self) -> list[tuple[int, int]]:
        """Grow the windows that disagree with a piece to about three times their length, join those that then
        touch, and give those still to encode. None is left once all agree; the whole text always does."""
        out: list[tuple[int, int]] = []
        for a, b in self.spans:
            left, right = self.differs((a, b))
            width = b - a
            if left:
                a = self.before(a - width)
            if right:
                b = self.after(b + width)
            while out and a <= out[-1][1]:
                c, d = out.pop()
                a, b = min(a, c), max(b, d)
            out.append((a, b))
        self.spans = out
        return [s for s in out if s not in self.made]

    def assemble(self) -> tuple:
        """Ids of the text, chunks of which ids were used, and code points encoded anew in windows."""
        import numpy as np

        edges = [0, *(x for s in self.spans for x in s), len(self.text)]
        out, reused = [], set()
        for n, (a, b) in enumerate(zip(edges[::2], edges[1::2], strict=True)):
            if a < b:  # between two windows lies a part of one piece
                k = bisect.bisect_right(self.starts, a) - 1
                out.append(self.ids[k][self.cut(k, a):self.cut(k, b)])
                reused.add(k)
            if n < len(self.spans):
                out.append(self.made[self.spans[n]])
        ids = np.concatenate(out) if out else np.zeros(0, np.int32)
        return ids, len(reused.difference(self.todo)), sum(b - a for a, b in self.spans)


def encode_with_chunks(texts: list[str], refs: list[list[dict]], enc) -> list[tuple]:
    """(ids, chunks reused, code points encoded anew) of each text; the ids are those of the whole text."""
    made = [Pieces(t, r or [], enc.token_size, enc.narrow) for t, r in zip(texts, refs, strict=True)]
    ids = iter(enc.encode([p.text[slice(*p.bounds[k])] for p in made for k in p.todo]))
    for p in made:
        for k in p.todo:
            p.ids[k] = next(ids)
    todo = [(p, s) for p in made for s in p.spans]
    while todo:  # until every window agrees with the pieces beside it
        for (p, s), x in zip(todo, enc.encode([p.text[slice(*s)] for p, s in todo]), strict=True):
            p.made[s] = x
        todo = [(p, s) for p in {id(p): p for p, _ in todo}.values() for s in p.widen()]
    out = [p.assemble() for p in made]
    special = [any(s in t for s in enc.special) for t in texts]
    # Special tokens' strings are cut out before anything else; ids of other texts (equal keys) don't decode to this one.
    wrong = [i for i, (t, x) in enumerate(zip(texts, out, strict=True))
             if special[i] or refs[i] and enc.decode_bytes(x[0]).tobytes() != t.encode()]
    for i, x in zip(wrong, enc.encode([texts[i] for i in wrong]), strict=True):
        out[i] = (x, 0, len(texts[i]))
    return out


def bpe_encode(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids (little-endian unsigned 32-bit integers), text (the ids decoded), n_reused (chunks of which ids were used)."""
    kind = dict(docs.dtypes)[id_col]
    texts = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("t"))
    # Keys of texts and chunks have 64 bits: should two collide, the last comparison finds the wrong ids.
    texts = texts.select("doc_id", F.xxhash64("t").alias("th"), "t")
    chunks = saved(chunk_rows(texts), "chunks")
    shared = chunks.groupBy("h").agg(F.count("*").alias("n"), F.min("th").alias("owner")).filter("n > 1").select("h", "owner")
    places = saved(chunks.join(shared, "h").select("th", "off", "len", "h", (F.col("th") == F.col("owner")).alias("own")).distinct(), "places")
    keyed = keyed_texts(texts)
    own = places.filter("own").groupBy("th").agg(F.collect_list(F.struct("off", "len", "h")).alias("own"))
    # Repeated texts: one row of each owns the chunks.
    first = keyed.join(own.hint("merge"), "th").select("doc_id", "th", "z", "own").dropDuplicates(["th"])
    # A chunk that its owner repeats is encoded at each of its places there; one stays.
    book = encode_owned(first, vocabulary).dropDuplicates(["h"])
    refs = (places.select("th", "off", "len", "h").join(book, "h").groupBy("th")
            .agg(F.collect_list(F.struct("off", "len", "ids")).alias("refs")))
    rows = keyed.join(refs.hint("merge"), "th", "left").select("doc_id", "z", "refs")

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        from .bpe import encoder

        enc = encoder(vocabulary)
        for batch in batches:
            for a in range(0, batch.num_rows, 128):
                b = batch.slice(a, 128)
                texts = [_text(z) for z in b.column(1).to_pylist()]
                refs = b.column(2).to_pylist()
                done = encode_with_chunks(texts, refs, enc)
                ids = [x[0] for x in done]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), pa.array([len(x) for x in ids], pa.int64()), pa.array([x.astype("<u4").tobytes() for x in ids], pa.binary()),
                     pa.array([enc.decode(x) for x in ids], pa.string()), pa.array([x[1] for x in done], pa.int64())],
                    ["doc_id", "n_tokens", "ids", "text", "n_reused"])

    return rows.mapInArrow(run, f"doc_id {kind}, n_tokens long, ids binary, text string, n_reused long")


def bpe_decode(tokens: DataFrame, vocabulary: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """doc_id, text: the decoded ids (null ids: empty)."""
    kind = dict(tokens.dtypes)[id_col]

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        from .bpe import encoder

        enc = encoder(vocabulary)
        for batch in batches:
            texts = [enc.decode(np.frombuffer(x or b"", "<u4")) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return tokens.select(F.col(id_col).alias("doc_id"), F.col(ids_col)).mapInArrow(run, f"doc_id {kind}, text string")
