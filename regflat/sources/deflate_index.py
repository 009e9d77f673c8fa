"""Access points into a DEFLATE stream, so that one compressed member is read by many tasks.

An access point is a bit at which a block begins, the place of its output, and the 32 KB of output before it.  One pass
inflates the member and, about every ``span`` compressed bytes, looks for the next block: bit positions whose code-length
code is complete (tested for all positions at once) are tried in order, and the first that goes on exactly like the
stream itself is taken.  zlib resumes at any bit when the bits before it are filled with empty blocks.  Each point keeps
the CRC of the output up to the next one, checked by whoever reads it.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np

WINDOW = 1 << 15
CHUNK = 1 << 18
REGION = 1 << 18  # compressed bytes searched for a block, and compared

# order in which a dynamic block states the lengths of its code-length code (RFC 1951, 3.2.7): fixed values
_ORDER = (16, 17, 18, 0, 8, 7, 9, 6, 10, 5, 11, 4, 12, 3, 13, 2, 14, 1, 15)


class Point(NamedTuple):
    bit: int  # of the compressed data
    lo: int  # place of the output from here on
    hi: int  # place of the next point's output
    window: bytes
    crc: int  # of the output from lo to hi


def _number(value: int, width: int) -> list[int]:
    return [value >> i & 1 for i in range(width)]


# blocks without output: ten bits with the fixed code; 93 bits with a code of its own for the end of block alone
_SHORT = [0, 1, 0] + [0] * 7
_LONG = ([0, 0, 1] + _number(0, 5) + _number(0, 5) + _number(len(_ORDER) - 4, 4)
         + [b for symbol in _ORDER for b in _number(symbol in (1, 18), 3)]
         + [1] + _number(138 - 11, 7) + [1] + _number(118 - 11, 7) + [0] + [0] + [0])


def resumed(first: int, bit: int, window: bytes) -> tuple[zlib._Decompress, bytes]:
    """An inflater that goes on at ``bit`` (0 to 7) of the byte ``first``, and the bytes to feed it for that byte."""
    inflate = zlib.decompressobj(-15, zdict=window) if window else zlib.decompressobj(-15)
    filling = list(_LONG) if bit % 2 else []
    while len(filling) % 8 != bit:
        filling += _SHORT
    whole = len(filling) - bit
    lead = bytes(np.packbits(np.array(filling[:whole], np.uint8), bitorder="little")) if whole else b""
    low = sum(b << i for i, b in enumerate(filling[whole:]))
    return inflate, lead + bytes([low | first & (0xFF << bit & 0xFF)])


def block_starts(data: bytes) -> np.ndarray:
    """Bits at which a dynamic block that is not the last may begin: all fields in range, the code-length code complete."""
    bits = np.unpackbits(np.frombuffer(data, np.uint8), bitorder="little")
    n = len(bits) - 17 - 3 * len(_ORDER)
    if n <= 0:
        return np.empty(0, np.int64)

    def field(at, offset, width):
        return sum(bits[at + offset + i].astype(np.int64) << i for i in range(width))

    at = np.flatnonzero((bits[:n] == 0) & (bits[1:n + 1] == 0) & (bits[2:n + 2] == 1))
    at = at[(field(at, 3, 5) <= 29) & (field(at, 8, 5) <= 29)]
    count = field(at, 13, 4) + 4
    room = np.zeros(len(at), np.int64)
    for k in range(len(_ORDER)):
        size = field(at, 17 + 3 * k, 3)
        room += np.where((k < count) & (size > 0), 128 >> size, 0)
    return at[room == 128]


def _begins(inflate, data: bytes, tail: bytes) -> tuple[int, bytes, bytes] | None:
    """First block of ``data`` (fed to ``inflate`` next): its bit, the output before it, the window there."""
    for c in block_starts(data[:len(data) // 2]).tolist():
        byte, bit = divmod(c, 8)
        true = inflate.copy()
        before = true.decompress(data[:byte + 1])
        window = (tail + before)[-WINDOW:]
        goes_on = true.decompress(data[byte + 1:])
        trial, lead = resumed(data[byte], bit, window)
        try:
            got = trial.decompress(lead + data[byte + 1:])
        except zlib.error:
            continue
        if goes_on and got == goes_on:
            return c, before, window
    return None


def access_points(read_at, size: int, span: int) -> list[Point]:
    """Points of the raw DEFLATE data that ``read_at(n, offset)`` gives, about ``span`` compressed bytes apart."""
    inflate = zlib.decompressobj(-15)
    out, tail, at, crc = 0, b"", 0, 0
    points, begun = [], (0, 0, b"")  # bit, place and window of the open point

    def took(data: bytes):
        nonlocal out, tail, crc
        out += len(data)
        crc = zlib.crc32(data, crc)
        tail = (tail + data)[-WINDOW:] if len(data) < WINDOW else data[-WINDOW:]

    target = span
    while at < size and not inflate.eof:
        if at >= target:
            data = read_at(min(REGION, size - at), at)
            found = _begins(inflate, data, tail)
            if found is not None:
                c, before, window = found
                byte = c // 8
                took(inflate.decompress(data[:byte + 1]))
                points.append(Point(*begun[:2], out, begun[2], crc))
                begun, crc = (8 * at + c, out, window), 0
                at += byte + 1
                target = at + span
                continue
            target = at + len(data)  # no dynamic block here: the span grows
        step = min(CHUNK, size - at, max(1, target - at))
        took(inflate.decompress(read_at(step, at)))
        at += step
    took(inflate.flush())
    points.append(Point(*begun[:2], out, begun[2], crc))
    return points


class BrokenIndex(ValueError):
    """What is inflated from an access point is not what the index saw."""


def inflated(read_at, size: int, point: Point) -> Iterator[bytes]:
    """Output from an access point to the end of the stream, as far as it is asked for; the point's part is checked."""
    byte, bit = divmod(point.bit, 8)
    inflate, lead = resumed(read_at(1, byte)[0], bit, point.window)
    at, crc, left = byte + 1, 0, point.hi - point.lo
    data = inflate.decompress(lead)
    while True:
        if left > 0 and data:
            crc, left = zlib.crc32(data[:left], crc), left - len(data)
            if left <= 0 and crc != point.crc:
                raise BrokenIndex(f"output from bit {point.bit} on differs")
        if data:
            yield data
        if inflate.eof or at >= size:
            if left > 0:
                raise BrokenIndex(f"the stream ends {left} bytes before the next point")
            return
        step = read_at(min(CHUNK, size - at), at)
        at += len(step)
        data = inflate.decompress(step)
