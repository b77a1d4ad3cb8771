"""CRC-32 of every n-gram of a text from running CRCs, in numpy.

The CRC register without its usual start value is linear over GF(2): after
the bytes of ``ab`` it is the register after ``a``, moved on by ``len(b)``
zero bytes, xor the register after ``b``.  So one scan that keeps the running
register yields the register of any substring by cancelling the shifted
prefix.  Words are laid out with one space between them, whatever stood
there, and an n-gram is such a substring.
"""

from __future__ import annotations

import numpy as np

from .textnp import LOWER, words

POLYNOMIAL = 0xEDB88320  # reflected CRC-32
FULL = np.uint32(0xFFFFFFFF)
BLOCK = 64

#: separators: after lower-casing A-Z, every ASCII byte but digits and a-z
SEPARATOR = np.ones(256, bool)
SEPARATOR[0x30:0x3A] = SEPARATOR[0x61:0x7B] = SEPARATOR[0x80:] = False

Shift = np.ndarray  # (4, 256): the register that each byte of a register becomes


def _byte_table() -> np.ndarray:
    c = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        c = np.where(c & 1, np.uint32(POLYNOMIAL) ^ (c >> np.uint32(1)), c >> np.uint32(1))
    return c


TABLE = _byte_table()


def shifted(tables: Shift, x: np.ndarray) -> np.ndarray:
    """The registers ``x``, moved on by the bytes that ``tables`` stand for."""
    return tables[0][x & np.uint32(255)] ^ tables[1][(x >> np.uint32(8)) & np.uint32(255)] ^ tables[2][(x >> np.uint32(16)) & np.uint32(255)] ^ tables[3][x >> np.uint32(24)]


def _zero_bytes() -> np.ndarray:
    """Shifts by 0 to BLOCK zero bytes, (BLOCK + 1, 4, 256)."""
    out = np.empty((BLOCK + 1, 4, 256), np.uint32)
    out[0] = np.arange(256, dtype=np.uint32) << (np.arange(4, dtype=np.uint32) * np.uint32(8))[:, None]
    for k in range(BLOCK):
        out[k + 1] = TABLE[out[k] & np.uint32(255)] ^ (out[k] >> np.uint32(8))
    return out


ZEROS = _zero_bytes()


def _doubled(tables: Shift) -> Shift:
    return shifted(tables, tables)


def _powers() -> np.ndarray:
    """Shifts by BLOCK * 2**b zero bytes, b up to 31."""
    out = [ZEROS[BLOCK]]
    for _ in range(31):
        out.append(_doubled(out[-1]))
    return np.stack(out)


POWERS = _powers()


def shift_by(x: np.ndarray, n_bytes: np.ndarray) -> np.ndarray:
    """Each register moved on by its own number of zero bytes."""
    small = n_bytes % BLOCK
    x = (ZEROS[small, 0, x & np.uint32(255)] ^ ZEROS[small, 1, (x >> np.uint32(8)) & np.uint32(255)]
         ^ ZEROS[small, 2, (x >> np.uint32(16)) & np.uint32(255)] ^ ZEROS[small, 3, x >> np.uint32(24)])
    blocks = n_bytes // BLOCK
    b = 0
    while len(x) and (blocks >> b).any():
        at = np.flatnonzero((blocks >> b) & 1)
        x[at] = shifted(POWERS[b], x[at])
        b += 1
    return x


def _carried(values: np.ndarray, tables: Shift) -> np.ndarray:
    """c with c[0] = 0 and c[k + 1] = shifted(c[k]) ^ values[k]: lanes of
    BLOCK values advance together, the lanes' ends are carried likewise."""
    n = len(values)
    if n <= BLOCK:
        out = np.zeros(n + 1, np.uint32)
        for k in range(n):
            out[k + 1] = shifted(tables, out[k:k + 1])[0] ^ values[k]
        return out
    lanes = -(-n // BLOCK)
    grid = np.zeros(lanes * BLOCK, np.uint32)
    grid[:n] = values
    grid = np.ascontiguousarray(grid.reshape(lanes, BLOCK).T)
    inner, c = np.empty_like(grid), np.zeros(lanes, np.uint32)
    for i in range(BLOCK):
        c = shifted(tables, c) ^ grid[i]
        inner[i] = c
    far = tables
    for _ in range(BLOCK.bit_length() - 1):
        far = _doubled(far)
    start = _carried(inner[-1], far)[:lanes]
    for i in range(BLOCK):
        start = shifted(tables, start)
        inner[i] ^= start
    return np.concatenate([[np.uint32(0)], inner.T.ravel()[:n]])


class Running:
    """Running CRC registers of a byte string, kept by blocks: inside a block
    from zero, and the register that each block starts with."""

    def __init__(self, data: np.ndarray):
        n_blocks = len(data) // BLOCK + 1
        grid = np.zeros(n_blocks * BLOCK, np.uint8)
        grid[:len(data)] = data
        grid = np.ascontiguousarray(grid.reshape(n_blocks, BLOCK).T)
        self.inner, c = np.zeros((BLOCK + 1, n_blocks), np.uint32), np.zeros(n_blocks, np.uint32)
        for i in range(BLOCK):
            c = TABLE[(c ^ grid[i]) & np.uint32(255)] ^ (c >> np.uint32(8))
            self.inner[i + 1] = c
        self.start = _carried(c, ZEROS[BLOCK])

    def at(self, place: np.ndarray) -> np.ndarray:
        """The register after the first ``place`` bytes."""
        block, off = place // BLOCK, place % BLOCK
        return self.inner[off, block] ^ shift_by(self.start[block], off)

    def crc(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """CRC-32 of the bytes in [start, end), with the usual start value and final xor."""
        return self.at(end) ^ shift_by(self.at(start) ^ FULL, end - start) ^ FULL


def ngram_crcs(data: np.ndarray, offs: np.ndarray, max_n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """CRCs of all runs of 1 to ``max_n`` words of texts laid end to end, row
    by row; offsets of the rows in them; words of each row."""
    lower = LOWER[data]
    starts, ends, first = words(data, offs, SEPARATOR[LOWER])
    size = ends - starts
    begin = np.cumsum(size + 1) - (size + 1)  # with one space after every word
    joined = np.full(int(begin[-1] + size[-1] + 1) if len(size) else 0, 32, np.uint8)
    holds = np.ones(len(joined), bool)
    holds[begin + size] = False
    joined[holds] = lower[~SEPARATOR[lower]]
    running = Running(joined)
    n_words = np.diff(first)
    row = np.repeat(np.arange(len(n_words)), n_words)
    found, rows = [], []
    for n in range(1, max_n + 1):
        at = np.arange(len(starts) - n + 1) if len(starts) >= n else np.zeros(0, np.int64)
        at = at[row[at] == row[at + n - 1]] if len(at) else at
        found.append(running.crc(begin[at], begin[at + n - 1] + size[at + n - 1]))
        rows.append(row[at])
    crc, row = np.concatenate(found), np.concatenate(rows)
    if max_n > 1:
        order = np.argsort(row, kind="stable")
        crc, row = crc[order], row[order]
    return crc, np.searchsorted(row, np.arange(len(n_words) + 1)), n_words
