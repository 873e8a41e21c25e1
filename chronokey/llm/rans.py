"""Static range asymmetric numeral system over token ids, interleaved and blocked, in numpy.

A segment is a byte string: a header (magic, counts), the frequency table that all
its blocks share, a checkpoint per block (ids before it, offset of its words,
CRC-32 of its ids), the documents' sizes, then each block's final lane states and
words. Blocks are independent: any of them can be decoded from its checkpoint
and the shared table. Inside a block, id i goes to lane i mod LANES.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

MAGIC = b"RANSEG01"
LANES, ROWS = 128, 512
BLOCK = LANES * ROWS
TOGETHER = 32  # blocks that one pass of array operations handles
LOW = np.uint64(1 << 31)
HEADER = struct.Struct("<8sIQIIQ")  # magic, bits, ids, blocks, bytes of the table, words


def quantise(counts: np.ndarray, bits: int) -> np.ndarray:
    """Frequencies of at least 1 that sum to 2 ** bits."""
    total = 1 << bits
    freq = np.maximum(1, counts * total // counts.sum())
    order = np.argsort(-freq, kind="stable")
    over = int(freq.sum()) - total
    if over < 0:
        freq[order[0]] -= over
    while over > 0:
        give = np.minimum(freq[order] - 1, np.maximum(1, freq[order] * over // max(1, int(freq[order].sum()))))
        give = np.minimum(give, np.maximum(0, over - (np.cumsum(give) - give)))
        freq[order] -= give
        over -= int(give.sum())
    return freq


def _spread(ids: np.ndarray, pad: int) -> np.ndarray:
    """(rows, blocks * lanes) of symbols of equal blocks."""
    blocks = max(1, len(ids) // BLOCK) if len(ids) >= BLOCK else 1
    rows = -(-len(ids) // (LANES * blocks))
    full = np.full(blocks * rows * LANES, pad, ids.dtype)
    full[:len(ids)] = ids
    return full.reshape(blocks, rows, LANES).transpose(1, 0, 2).reshape(rows, blocks * LANES)


def _encode(symbols: np.ndarray, freq: np.ndarray, cum: np.ndarray, bits: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """(states, words) of each block of a spread."""
    rows, lanes = symbols.shape
    f, c = freq[symbols], cum[symbols]
    words, out = np.zeros(symbols.shape, np.uint32), np.zeros(symbols.shape, bool)
    x = np.full(lanes, LOW)
    limit = f << np.uint64(63 - bits)
    shift = np.uint64(bits)
    for t in range(rows - 1, -1, -1):
        full = x >= limit[t]
        out[t] = full
        words[t] = x  # the low 32 bits
        x = np.where(full, x >> np.uint64(32), x)
        q = x // f[t]
        x = (q << shift) + (x - q * f[t]) + c[t]
    blocks = lanes // LANES
    cut = [slice(b * LANES, (b + 1) * LANES) for b in range(blocks)]
    return [(x[s], words[:, s][out[:, s]]) for s in cut]


def encode_segment(ids: np.ndarray, sizes: np.ndarray) -> bytes:
    """``ids`` of some documents in order, ``sizes`` of them each."""
    if not len(ids):
        return HEADER.pack(MAGIC, 0, 0, 0, 0, 0) + struct.pack("<I", len(sizes)) + sizes.astype("<u8").tobytes()
    seen = np.bincount(ids)
    used = np.flatnonzero(seen)
    counts = seen[used]
    place = np.zeros(len(seen), np.int32)
    place[used] = np.arange(len(used))
    symbols = place[ids]
    bits = max(16, int(len(used) - 1).bit_length() + 1)
    freq = quantise(counts.astype(np.int64), bits)
    cum = np.cumsum(freq) - freq
    table = zlib.compress(np.diff(used, prepend=0).astype("<u4").tobytes() + freq.astype("<u4").tobytes(), 6)
    f, c = freq.astype(np.uint64), cum.astype(np.uint64)
    pad = int(np.argmax(freq))
    whole = len(symbols) // BLOCK * BLOCK
    blocks = []
    for a in range(0, whole, BLOCK * TOGETHER):
        blocks += _encode(_spread(symbols[a:min(whole, a + BLOCK * TOGETHER)], pad), f, c, bits)
    if whole < len(symbols):
        blocks += _encode(_spread(symbols[whole:], pad), f, c, bits)
    raw = ids.astype("<u4")
    words = np.cumsum([0, *(len(w) for _, w in blocks)])
    points = b"".join(struct.pack("<QQI", k * BLOCK, int(words[k]), zlib.crc32(raw[k * BLOCK:(k + 1) * BLOCK].tobytes()))
                      for k in range(len(blocks)))
    return b"".join([HEADER.pack(MAGIC, bits, len(ids), len(blocks), len(table), int(words[-1])), struct.pack("<I", len(sizes)),
                     sizes.astype("<u8").tobytes(), table, points,
                     *(s.astype("<u8").tobytes() for s, _ in blocks), *(w.astype("<u4").tobytes() for _, w in blocks)])


def decode_segment(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(ids, sizes of the documents); raises ValueError on a wrong magic number, state or checksum."""
    magic, bits, n, blocks, table_size, n_words = HEADER.unpack_from(data)
    if magic != MAGIC:
        raise ValueError("not a token segment")
    at = HEADER.size
    docs = struct.unpack_from("<I", data, at)[0]
    sizes = np.frombuffer(data, "<u8", docs, at + 4).astype(np.int64)
    at += 4 + 8 * docs
    if not n:
        return np.zeros(0, np.uint32), sizes
    table = np.frombuffer(zlib.decompress(data[at:at + table_size]), "<u4")
    used, freq = np.cumsum(table[:len(table) // 2], dtype=np.uint32), table[len(table) // 2:].astype(np.int64)
    cum = np.cumsum(freq) - freq
    symbol = np.repeat(np.arange(len(freq)), freq)
    slot_freq = freq[symbol].astype(np.uint64)
    slot_bias = (np.arange(1 << bits) - cum[symbol]).astype(np.uint64)
    at += table_size
    points = list(struct.iter_unpack("<QQI", data[at:at + 20 * blocks]))
    at += 20 * blocks
    states = np.frombuffer(data, "<u8", blocks * LANES, at).reshape(blocks, LANES)
    words = np.append(np.frombuffer(data, "<u4", n_words, at + 8 * blocks * LANES).astype(np.uint64), np.uint64(0))
    ids = np.zeros(n, np.uint32)
    mask, shift = np.uint64((1 << bits) - 1), np.uint64(bits)

    def run(first: int, last: int, rows: int) -> np.ndarray:
        x = states[first:last].copy()
        at = np.array([p[1] for p in points[first:last]], np.int64)[:, None]
        out = np.zeros((rows, last - first, LANES), np.int32)
        for t in range(rows):
            slot = x & mask
            out[t] = symbol[slot]
            x = slot_freq[slot] * (x >> shift) + slot_bias[slot]
            low = x < LOW
            place = np.cumsum(low, axis=1)
            x = np.where(low, (x << np.uint64(32)) | words[np.where(low, at + place - 1, 0)], x)
            at = at + place[:, -1:]
        if (x != LOW).any():
            raise ValueError("a lane does not end in the state it began with")
        return out.transpose(1, 0, 2).reshape(last - first, rows * LANES)

    whole = n // BLOCK
    for a in range(0, whole, TOGETHER):
        b = min(whole, a + TOGETHER)
        ids[a * BLOCK:b * BLOCK] = used[run(a, b, ROWS).reshape(-1)]
    if whole < blocks:
        rest = n - whole * BLOCK
        ids[whole * BLOCK:] = used[run(whole, blocks, -(-rest // LANES)).reshape(-1)[:rest]]
    for k, (first, _, crc) in enumerate(points):
        if zlib.crc32(ids[first:first + BLOCK].astype("<u4").tobytes()) != crc:
            raise ValueError(f"checksum of block {k} differs")
    return ids, sizes
