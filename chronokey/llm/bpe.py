"""Byte-level BPE over batches of texts in numpy, equal to the tokenizers library.

A text is cut into the pre-tokens of the byte-level pattern by array operations
on its code points. Pre-tokens are looked up in a hash table of those met before
in this worker (bounded, emptied when full); new ones are encoded one by one. The
result of each batch is decoded and compared with the text; a text that differs, or
has characters outside the classified range, or a special token's string, is
encoded by the tokenizers library itself. Vocabulary files are read by path.
"""

from __future__ import annotations

import functools
import json
import re
import unicodedata

import numpy as np

#: Code points that the array path classifies: Latin to Cyrillic, general punctuation, the euro sign.
LIMIT = 0x20AD
LETTER, NUMBER, SPACE, OTHER, BREAK, UNKNOWN = range(6)
#: Pre-tokens held by a worker, code points handled at once, and where a longer text may be cut.
TABLE_BITS, BATCH_CHARS = 20, 200_000
HARD = re.compile(r"(?<=[A-Za-z]) (?=[A-Za-z])")
MULTIPLIER = 0x9E3779B97F4A7C15


def _classes() -> np.ndarray:
    out = np.full(LIMIT + 1, UNKNOWN, np.uint8)
    for cp in [*range(0x500), *range(0x2000, 0x2070), 0x20AC]:
        kind = unicodedata.category(chr(cp))
        if kind != "Cn":
            out[cp] = LETTER if kind[0] == "L" else NUMBER if kind[0] == "N" else OTHER
    for a, b in ((0x09, 0x0D), (0x20, 0x20), (0x85, 0x85), (0xA0, 0xA0), (0x2000, 0x200A), (0x2028, 0x2029), (0x202F, 0x202F), (0x205F, 0x205F)):
        out[a:b + 1] = SPACE
    return out


def byte_of_symbol() -> dict[str, int]:
    """The printable stand-ins of byte-level vocabularies: printable Latin-1 is itself, others follow from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def gather(flat: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Concatenation of flat[start : start + size]."""
    ends = np.cumsum(size)
    if not len(ends) or not ends[-1]:
        return flat[:0]
    return flat[np.repeat(start - (ends - size), size) + np.arange(ends[-1])]


@functools.cache
def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up = np.full(n, MULTIPLIER, np.uint64)
    down = np.full(n, pow(MULTIPLIER, -1, 1 << 64), np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up), np.cumprod(down)


@functools.cache
def char_values() -> np.ndarray:
    return np.random.default_rng(2024).integers(1, 1 << 63, LIMIT + 1, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


class Prefix:
    """Hashes of any stretch of a code point array in constant time."""

    def __init__(self, cps: np.ndarray):
        n = 1 << max(10, int(len(cps)).bit_length())
        up, self.down = powers(n)
        value = char_values()[np.minimum(cps, LIMIT)]
        if len(cps) and cps.max() >= LIMIT:  # characters beyond the table by their number
            value = np.where(cps >= LIMIT, (cps.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93), value)
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(value * up[:len(cps)], dtype=np.uint64)])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.sums[end] - self.sums[start]) * self.down[start]


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def stretches(text: str, limit: int = BATCH_CHARS) -> list[str]:
    """A text cut at places that every pre-tokenisation cuts: before a space between letters."""
    out = []
    while len(text) > limit:
        cut = HARD.search(text, limit)
        if not cut:
            break
        out.append(text[:cut.start()])
        text = text[cut.start():]
    return [*out, text]


class Encoder:
    """Encodes and decodes batches of texts with a byte-level BPE vocabulary file of the tokenizers library."""

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            model = json.load(f)
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        symbol = byte_of_symbol()
        vocab = model["model"]["vocab"]
        self.special = [t["content"] for t in model["added_tokens"]]
        byte_of = {i: bytes(symbol[c] for c in s) for s, i in vocab.items() if s not in self.special}
        merged = [vocab["".join(m if isinstance(m, list) else m.split(" "))] for m in model["model"]["merges"]]
        if merged != sorted(merged):
            raise ValueError("ids don't follow the order of merges")
        self.core = tiktoken.Encoding("own", pat_str=r"\S+|\s+", mergeable_ranks={b: i for i, b in byte_of.items()}, special_tokens={})._core_bpe
        size = max([*byte_of, *(t["id"] for t in model["added_tokens"])]) + 1
        strings = [byte_of.get(i, b"") for i in range(size)]
        for t in model["added_tokens"]:
            strings[t["id"]] = t["content"].encode()
        self.token_bytes = np.frombuffer(b"".join(strings), np.uint8)
        self.token_size = np.array([len(s) for s in strings], np.int64)
        self.token_start = np.cumsum(self.token_size) - self.token_size
        self.kind = _classes()
        self.size = size
        self.narrow = "<u2" if size <= 1 << 16 else "<u4"  # how the ids of shared chunks travel
        self.clear()

    def clear(self) -> None:
        n = 1 << (TABLE_BITS + 1)
        self.keys, self.slot = np.zeros(n, np.uint64), np.full(n, -1, np.int32)
        self.flat = np.zeros(1 << 20, np.int32)
        self.used = self.words = 0
        self.start, self.count = np.zeros(1 << TABLE_BITS, np.int64), np.zeros(1 << TABLE_BITS, np.int64)

    def find(self, h: np.ndarray) -> np.ndarray:
        """Word numbers of hashes, -1 for unknown ones."""
        at = (h >> np.uint64(64 - TABLE_BITS - 1)).astype(np.int64)
        out = self.slot[at]
        open_ = np.flatnonzero((out >= 0) & (self.keys[at] != h))
        while len(open_):
            at[open_] = (at[open_] + 1) & (len(self.keys) - 1)
            found = self.slot[at[open_]]
            out[open_] = found
            open_ = open_[(found >= 0) & (self.keys[at[open_]] != h[open_])]
        return out

    def add(self, h: np.ndarray, words: list[bytes]) -> None:
        ids = [self.core.encode_single_piece(w) for w in words]
        sizes = np.array([len(x) for x in ids], np.int64)
        new = np.fromiter((i for x in ids for i in x), np.int32, int(sizes.sum()))
        while self.used + len(new) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        self.flat[self.used:self.used + len(new)] = new
        k = slice(self.words, self.words + len(h))
        self.count[k], self.start[k] = sizes, self.used + np.cumsum(sizes) - sizes
        number = np.arange(self.words, self.words + len(h), dtype=np.int32)
        self.used, self.words = self.used + len(new), self.words + len(h)
        at, todo = (h >> np.uint64(64 - TABLE_BITS - 1)).astype(np.int64), np.arange(len(h))
        while len(todo):
            free = todo[self.slot[at[todo]] < 0]
            self.slot[at[free]] = number[free]
            self.keys[at[free]] = h[free]
            todo = todo[self.slot[at[todo]] != number[todo]]
            at[todo] = (at[todo] + 1) & (len(self.keys) - 1)

    def token_starts(self, cps: np.ndarray, kind: np.ndarray) -> np.ndarray:
        """Mask of the code points at which a pre-token begins. The last code point is a break."""
        begin = np.ones(len(cps), bool)
        np.not_equal(kind[1:], kind[:-1], out=begin[1:])
        breaks = np.flatnonzero(kind == BREAK)
        begin[breaks] = True
        begin[np.minimum(breaks + 1, len(cps) - 1)] = True
        # The last white space before a word stands apart, and joins it if it is a plain space.
        last = np.flatnonzero((kind[:-1] == SPACE) & (kind[1:] != SPACE) & (kind[1:] != BREAK))
        begin[last] = True
        begin[last[cps[last] == 32] + 1] = False
        quotes = np.flatnonzero((cps == 39) & begin)
        if len(quotes):
            text = np.concatenate([cps, [0, 0]])
            one, two = text[quotes + 1], text[quotes + 2]
            single = np.isin(one, [ord(c) for c in "stmd"])
            double = ((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
            for places, size in ((quotes[single], 1), (quotes[double], 2)):
                begin[places + 1] = False
                begin[places + 1 + size] = True
        return begin

    def _batch(self, texts: list[str]) -> list[np.ndarray]:
        sizes = np.array([len(t) for t in texts], np.int64)
        joined = "\n".join([*texts, ""])
        cps = code_points(joined)
        breaks = np.cumsum(sizes + 1) - 1
        kind = self.kind[np.minimum(cps, LIMIT)]
        kind[breaks] = BREAK
        bad = np.flatnonzero(kind == UNKNOWN)
        slow = set(np.searchsorted(breaks, bad).tolist())
        slow |= {i for s in self.special if s in joined for i, t in enumerate(texts) if s in t}
        begin = np.flatnonzero(self.token_starts(cps, kind))
        end = np.append(begin[1:], len(cps))
        word = kind[begin] != BREAK
        begin, end = begin[word], end[word]
        h = Prefix(cps).of(begin, end)
        number = self.find(h)
        missing = np.flatnonzero(number < 0)
        if len(missing):
            fresh, first = np.unique(h[missing], return_index=True)
            if self.words + len(fresh) > len(self.start):
                self.clear()
                number = self.find(h)
                missing = np.arange(len(h))
                fresh, first = np.unique(h, return_index=True)
            at = missing[first]
            self.add(fresh, [joined[b:e].encode("utf-8", "surrogatepass") for b, e in zip(begin[at].tolist(), end[at].tolist(), strict=True)])
            number[missing] = self.find(h[missing])
        count = self.count[number]
        ids = gather(self.flat, self.start[number], count)
        ends = np.concatenate([[0], np.cumsum(count)])
        upto = ends[np.searchsorted(begin, breaks)]
        out = np.split(ids, upto[:-1])
        if self.decode_bytes(ids).tobytes() != "".join(texts).encode("utf-8", "surrogatepass"):
            slow |= {i for i, t in enumerate(texts) if self.decode_bytes(out[i]).tobytes() != t.encode("utf-8", "surrogatepass")}
        for i in slow:
            out[i] = np.array(self.library.encode(texts[i], add_special_tokens=False).ids, np.int32)
        return out

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids (int32) of each text."""
        parts = [(i, p) for i, t in enumerate(texts) for p in (stretches(t) if len(t) > BATCH_CHARS and not any(s in t for s in self.special) else [t])]
        done: list[list[np.ndarray]] = [[] for _ in texts]
        held, chars = [], 0
        for k, (i, p) in enumerate(parts):
            held.append((i, p))
            chars += len(p)
            if chars >= BATCH_CHARS or len(held) >= 4096 or k + 1 == len(parts):
                for (j, _), ids in zip(held, self._batch([p for _, p in held]), strict=True):
                    done[j].append(ids)
                held, chars = [], 0
        return [x[0] if len(x) == 1 else np.concatenate(x) for x in done]

    def decode_bytes(self, ids: np.ndarray) -> np.ndarray:
        return gather(self.token_bytes, self.token_start[ids], self.token_size[ids])

    def decode(self, ids: np.ndarray) -> str:
        return self.decode_bytes(ids).tobytes().decode("utf-8", "replace")


@functools.cache
def encoder(path: str) -> Encoder:
    """One encoder per worker process and vocabulary file."""
    return Encoder(path)
