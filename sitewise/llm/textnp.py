"""Numpy text kernels that run inside Arrow-batched tasks.

A chunk of documents is one UTF-8 byte array plus row offsets, so words,
lines and shingles of all its documents come from a few vectorised passes.
White space is ASCII 0x20 and 0x09-0x0D; every other byte belongs to a word,
which is exact on UTF-8 because those bytes never occur inside a multi-byte
character.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_BASE2 = np.uint64(0xC2B2AE3D27D4EB4F | 1)
_pow: dict[int, tuple[np.ndarray, np.ndarray]] = {}

SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def text_chunks(col: pa.Array | pa.ChunkedArray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) pieces of a string column; null
    counts as empty; a row is never split, so one long row is a piece of its own."""
    for arr in col.chunks if isinstance(col, pa.ChunkedArray) else [col]:
        arr = arr.cast(pa.large_binary()) if not pa.types.is_large_binary(arr.type) else arr
        if arr.null_count:
            arr = arr.fill_null(b"")
        n = len(arr)
        if not n:
            continue
        offs = np.frombuffer(arr.buffers()[1], np.int64)[arr.offset:arr.offset + n + 1]
        data = np.frombuffer(arr.buffers()[2], np.uint8) if arr.buffers()[2] is not None else np.zeros(0, np.uint8)
        lo = 0
        while lo < n:
            hi = max(lo + 1, int(np.searchsorted(offs, offs[lo] + limit, "right")) - 1)
            hi = min(hi, n)
            yield lo, hi, data[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo]
            lo = hi


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser: every input bit reaches every output bit (a bijection)."""
    x = x ^ (x >> np.uint64(33))
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(32)
    return x


def _powers(n: int, base: np.uint64) -> tuple[np.ndarray, np.ndarray]:
    """base**j and its inverse mod 2**64 for j <= n, grown on demand."""
    key = int(base)
    if key not in _pow or len(_pow[key][0]) <= n:
        size = max(n + 1, CHUNK_BYTES + 4096)
        inv = np.uint64(pow(key, -1, 1 << 64))
        p, q = np.full(size, base, np.uint64), np.full(size, inv, np.uint64)
        p[0] = q[0] = 1
        _pow[key] = (np.multiply.accumulate(p), np.multiply.accumulate(q))
    return _pow[key]


def prefix_hash(data: np.ndarray, base: np.uint64 = _BASE) -> np.ndarray:
    """P with P[i] = sum over j < i of (byte j + 1) * base**j mod 2**64."""
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _powers(len(data), base)[0][:len(data)], out=out[1:])
    return out


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray, base: np.uint64 = _BASE) -> np.ndarray:
    """Position-free 64-bit hash of the bytes in [start, end), from the prefix sums."""
    raw = (prefix[end] - prefix[start]) * _powers(len(prefix), base)[1][start]
    return mix(raw + (end - start).astype(np.uint64) * np.uint64(0x632BE59BD9B4E019))


def words(data: np.ndarray, offs: np.ndarray, space: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of each word, and for each row the index of its first word (n_rows + 1)."""
    inside = ~space[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offs] = True
    before = np.empty(len(data), bool)
    after = np.empty(len(data), bool)
    if len(data):
        before[0], after[-1] = True, True
        before[1:] = ~inside[:-1]
        after[:-1] = ~inside[1:]
    before |= edge[:-1]
    after |= edge[1:]
    starts = np.flatnonzero(inside & before)
    ends = np.flatnonzero(inside & after) + 1
    return starts, ends, np.searchsorted(starts, offs)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return span_hash(prefix_hash(data), starts, ends)


def shingles(word_hash: np.ndarray, first: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all n-word windows of each row and per-row offsets; a row of
    1 to n-1 words has one shingle, its whole sequence; a row without words none."""
    count = np.diff(first)
    per = np.where(count >= n, count - n + 1, (count > 0).astype(count.dtype))
    offs = np.concatenate([[0], np.cumsum(per)])
    row = np.repeat(np.arange(len(count)), per)
    at = first[row] + np.arange(offs[-1]) - offs[row]
    have = np.minimum(n, count)[row]
    acc = np.zeros(len(at), np.uint64)
    padded = np.concatenate([word_hash, np.zeros(n, np.uint64)])
    for k in range(n):
        acc = mix(acc + np.where(k < have, padded[at + k], np.uint64(k + 1)) + np.uint64(0x9E3779B97F4A7C15))
    return acc, offs


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every w consecutive values (len(x) - w + 1 of them), two block scans."""
    n = len(x)
    if w <= 1 or n <= 1:
        return x[:max(0, n - w + 1)].copy()
    pad = -n % w
    full = np.concatenate([x, np.full(pad, np.iinfo(x.dtype).max, x.dtype)]) if pad else x
    blocks = full.reshape(-1, w)
    fwd = np.minimum.accumulate(blocks, axis=1).ravel()
    bwd = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(bwd[:n - w + 1], fwd[w - 1:n])
