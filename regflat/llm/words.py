"""Words of whole texts as 64-bit hashes, computed on Arrow buffers with numpy.

A word is a run of bytes other than \\x20 and \\x09 to \\x0D.  Its hash is a
polynomial over a fixed table of 256 random values, taken from prefix sums, so
a batch of texts costs a few passes over its bytes and no loop over words.
Words are told apart by 64-bit hash: two different words collide with a
probability of about 2**-64 per pair.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK = 1 << 18  # bytes of text worked on at once (a longer text is a chunk of its own), with arrays many times its size

_rng = np.random.default_rng(20240229)
_TABLE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_FOLDED = _TABLE.copy()
_FOLDED[65:91] = _TABLE[97:123]  # A-Z as a-z
_BASE = 0x9E3779B97F4A7C15 | 1
_IS_WORD = np.ones(256, bool)
_IS_WORD[[32, 9, 10, 11, 12, 13]] = False
_powers: list[np.ndarray] = []


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _powers or len(_powers[0]) < n:
        size = max(CHUNK, n) + 1
        both = []
        for base in (_BASE, pow(_BASE, -1, 2**64)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            both.append(np.multiply.accumulate(steps))
        _powers[:] = both
    return _powers[0], _powers[1]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def hash_words(data: np.ndarray, offsets: np.ndarray, fold: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of the texts ``data[offsets[i]:offsets[i+1]]``; where the words of each text begin (n + 1)."""
    base = int(offsets[0])
    data = data[base:int(offsets[-1])]
    offsets = offsets.astype(np.int64) - base
    if not len(data):
        return np.empty(0, np.uint64), np.zeros(len(offsets), np.int64)
    is_word = _IS_WORD.take(data)
    before = np.empty_like(is_word)
    before[0], before[1:] = False, is_word[:-1]
    after = np.empty_like(is_word)
    after[-1], after[:-1] = False, is_word[1:]
    inner = offsets[(offsets > 0) & (offsets < len(data))]
    before[inner] = False
    after[inner - 1] = False
    start = np.flatnonzero(is_word & ~before)
    end = np.flatnonzero(is_word & ~after) + 1
    power, inverse = _power_tables(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    values = (_FOLDED if fold else _TABLE).take(data)
    values *= power[:len(data)]
    np.cumsum(values, out=total[1:])
    h = mix((total[end] - total[start]) * inverse[start] + (end - start).astype(np.uint64))
    return h, np.searchsorted(start, offsets)


def rolling(h: np.ndarray, width: int) -> np.ndarray:
    """Hash of every run of ``width`` values, in order (the caller masks runs that cross texts)."""
    n = len(h) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out, have, part, part_width = None, 0, h, 1
    rest = width
    while rest:  # binary decomposition of the width
        if rest & 1:
            piece = part[have:have + n]
            out = piece.copy() if out is None else mix(out * np.uint64(_BASE) + piece)
            have += part_width
        rest >>= 1
        if rest:
            m = len(part) - part_width
            part = mix(part[:m] * np.uint64(0xD6E8FEB86659FD93) + part[part_width:])
            part_width *= 2
    return out


def slide(x: np.ndarray, width: int, least: bool = True) -> np.ndarray:
    """Minimum (or maximum) of every ``width`` consecutive values."""
    op, have = (np.minimum if least else np.maximum), 1
    if len(x) < width:
        return x[:0]
    while have * 2 <= width:
        x = op(x[:-have], x[have:])
        have *= 2
    return op(x[:len(x) - (width - have)], x[width - have:]) if width > have else x


def texts(column: pa.Array, max_bytes: int = CHUNK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Slices of a text column as (first row, last row, bytes, offsets); nulls as empty texts."""
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    if not len(column):
        return
    _, at, body = column.buffers()
    offsets = np.frombuffer(at, np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(body, np.uint8) if body is not None and body.size else np.empty(0, np.uint8)
    lo = 0
    while lo < len(column):
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + max_bytes, side="right")) - 1)
        hi = min(hi, len(column))
        yield lo, hi, data, offsets[lo:hi + 1]
        lo = hi
