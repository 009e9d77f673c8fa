"""One definition of where records begin and end in XML bytes, for streams and for byte ranges read in parallel.

A record is a ``<tag ...>...</tag >`` or ``<tag ... />`` element; elements of the row tag do not nest.  Comments and CDATA
sections hide tags, quoted attribute values hide ``>``.  Text is lexed in pieces that are cut right before a ``<``: no
token holds a second ``<``, so none straddles a cut, and what a piece does is a map from the state before it to the state
after it.  Maps compose, so ranges of one file can be lexed apart and joined afterwards.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

# outside a record or inside one: in text, a comment, a CDATA section; in a start tag: plain, in a value in " or '
OUT, IN, OUT_COMMENT, IN_COMMENT, OUT_CDATA, IN_CDATA, OPEN, DOUBLE, SINGLE = range(9)
STATES = range(9)
BEGINS, ENDS = "begins", "ends"

_UNTIL = {OUT_COMMENT: (b"-->", OUT), IN_COMMENT: (b"-->", IN), OUT_CDATA: (b"]]>", OUT), IN_CDATA: (b"]]>", IN),
          DOUBLE: (b'"', OPEN), SINGLE: (b"'", OPEN)}
_IN_TAG = re.compile(rb"""[>"']""")


@lru_cache(maxsize=64)
def _patterns(tag: str) -> tuple[re.Pattern, re.Pattern]:
    name = re.escape(tag).encode()
    hides = rb"<!--|<!\[CDATA\["
    return re.compile(rb"<" + name + rb"(?=[\s>/])|" + hides), re.compile(rb"</" + name + rb"\s*>|" + hides)


def _step(tag: str, buf: bytes, at: int, state: int) -> tuple[int, int, str | None, int] | None:
    """(place, state, what happened, where) after the next token; None where the piece holds no more."""
    if state in _UNTIL:
        mark, after = _UNTIL[state]
        i = buf.find(mark, at)
        return None if i < 0 else (i + len(mark), after, None, 0)
    if state == OPEN:
        m = _IN_TAG.search(buf, at)
        if not m:
            return None
        c = m.group()
        if c != b">":
            return m.end(), DOUBLE if c == b'"' else SINGLE, None, 0
        if buf[m.start() - 1:m.start()] == b"/":
            return m.end(), OUT, ENDS, m.end()
        return m.end(), IN, None, 0
    m = _patterns(tag)[state == IN].search(buf, at)
    if not m:
        return None
    if m.group() == b"<!--":
        return m.end(), OUT_COMMENT if state == OUT else IN_COMMENT, None, 0
    if m.group() == b"<![CDATA[":
        return m.end(), OUT_CDATA if state == OUT else IN_CDATA, None, 0
    return (m.end(), OPEN, BEGINS, m.start()) if state == OUT else (m.end(), OUT, ENDS, m.end())


def lex(tag: str, piece: bytes, state: int, one_end: bool = False) -> tuple[int, list[tuple[str, int]]]:
    """State after a piece, and where records begin and end in it; with ``one_end`` no further than the first end."""
    at, events = 0, []
    while (found := _step(tag, piece, at, state)) is not None:
        at, state, what, where = found
        if what:
            events.append((what, where))
            if one_end and what is ENDS:
                break
    return state, events


def piece_map(tag: str, piece: bytes) -> list[int]:
    """State after a piece for every state before it; runs that meet are followed once."""
    known: dict[tuple[int, int], int] = {}
    out = []
    for state in STATES:
        at, path = 0, []
        while True:
            if (at, state) in known:
                end = known[at, state]
                break
            path.append((at, state))
            found = _step(tag, piece, at, state)
            if found is None:
                end = state
                break
            at, state = found[:2]
        known.update(dict.fromkeys(path, end))
        out.append(end)
    return out


def chain(maps: list[bytes]) -> list[int]:
    """State before each of the maps that follow one another from the start of a file on."""
    state, out = OUT, []
    for does in maps:
        out.append(state)
        state = does[state]
    return out


class Records:
    """Puts records together from pieces fed in order, from a given state; a record begun before the first piece is left out."""

    def __init__(self, tag: str, state: int = OUT):
        self.tag, self.state, self.parts = tag, state, None  # parts: of the open record that began here

    def feed(self, piece: bytes, only_open: bool = False) -> Iterator[bytes]:
        """Records that end in the piece; with ``only_open`` no further than the open one."""
        at = 0
        self.state, events = lex(self.tag, piece, self.state, only_open)
        for what, where in events:
            if what == BEGINS:
                self.parts, at = [], where
            elif self.parts is not None:
                yield b"".join([*self.parts, piece[at:where]])
                self.parts = None
                if only_open:
                    return
        if self.parts is not None:
            self.parts.append(piece[at:])


def pieces(chunks: Iterator[bytes]) -> Iterator[bytes]:
    """A stream of any chunks as pieces that are cut right before a ``<``."""
    held: list[bytes] = []
    for chunk in chunks:
        cut = chunk.rfind(b"<")
        if cut < 0 or (cut == 0 and not held):
            held.append(chunk)
            continue
        yield b"".join([*held, chunk[:cut]])
        held = [chunk[cut:]]
    if held:
        yield b"".join(held)
