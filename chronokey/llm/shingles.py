"""Word shingles and MinHash signatures in numpy.

Words are runs of characters other than space, tab, LF, VT, FF and CR. A shingle is
SIZE consecutive words; a text of fewer words has one shingle, all its words; a text
without words has none. Shingles are held as 64-bit hashes.
"""

from __future__ import annotations

import functools

import numpy as np

from .bpe import Prefix, code_points

SIZE = 5
BATCH_CHARS = 500_000
_MIX = np.uint64(0xD6E8FEB86659FD93)


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _MIX
    return h ^ (h >> np.uint64(29))


def word_spans(cps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    blank = (cps == 32) | ((cps >= 9) & (cps <= 13))
    edge = np.flatnonzero(np.diff(np.concatenate([[True], blank, [True]])))
    return edge[::2], edge[1::2]


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, start, end of each word, first word of each text and the end), code point places in the text."""
    sizes = np.array([len(t) for t in texts], np.int64)
    cps = code_points("\n".join([*texts, ""]))
    begin = np.cumsum(sizes + 1) - sizes - 1
    start, end = word_spans(cps)
    h = mix(Prefix(cps).of(start, end))
    first = np.append(np.searchsorted(start, begin), len(start))
    shift = np.repeat(begin, np.diff(first))
    return h, start - shift, end - shift, first


def runs_of(h: np.ndarray, k: int) -> np.ndarray:
    """Hashes of k consecutive words, for every place with k words from it on."""
    n = len(h) - k + 1
    out = np.zeros(max(n, 0), np.uint64)
    for j in range(k if n > 0 else 0):
        out = out * np.uint64(0x9E3779B97F4A7C15) + h[j:j + n]
    return mix(out)


def shingle_sets(texts: list[str], size: int = SIZE) -> list[np.ndarray]:
    """Sorted distinct shingles of each text."""
    out: list[np.ndarray] = []
    at = 0
    while at < len(texts):
        upto, chars = at, 0
        while upto < len(texts) and (upto == at or chars + len(texts[upto]) <= BATCH_CHARS):
            chars += len(texts[upto])
            upto += 1
        h, _, _, first = word_hashes(texts[at:upto])
        whole = runs_of(h, size)
        for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
            if b - a >= size:
                out.append(np.unique(whole[a:b - size + 1]))
            else:
                out.append(runs_of(h[a:b], b - a) if b > a else h[:0])
        at = upto
    return out


@functools.cache
def permutations(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Universal hash functions (a x + b) / 2 ** 48, a odd."""
    rng = np.random.default_rng(20240917)
    a = rng.integers(0, 1 << 63, 4096, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    b = rng.integers(0, 1 << 63, 4096, dtype=np.uint64) * np.uint64(2)
    return a[:n, None], b[:n, None]


def signatures(sets: list[np.ndarray], n: int) -> np.ndarray:
    """(texts, n) MinHash values, 16 bits of each; a text without shingles has zeros.

    The minimum is taken over 64 bits; the low 16 bits of its mixed value are kept,
    so different minima agree with probability 2 ** -16.
    """
    a, b = permutations(n)
    out = np.zeros((len(sets), n), np.uint16)
    for i, s in enumerate(sets):
        if len(s):
            low = np.full(n, ~np.uint64(0))
            for k in range(0, len(s), 1024):
                np.minimum(low, (a * s[None, k:k + 1024] + b).min(axis=1), out=low)
            out[i] = mix(low) & np.uint64(0xFFFF)
    return out


def set_key(s: np.ndarray) -> bytes:
    import xxhash

    return xxhash.xxh3_128_digest(s.tobytes())


def alike(a: np.ndarray, b: np.ndarray, numerator: int, denominator: int) -> tuple[int, int, bool]:
    """(common, all, whether common / all >= numerator / denominator) of two sets; two empty ones are alike."""
    common = len(np.intersect1d(a, b, assume_unique=True))
    union = len(a) + len(b) - common
    return common, union, common * denominator >= numerator * union
