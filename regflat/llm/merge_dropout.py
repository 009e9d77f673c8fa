"""Subword encoding with seeded merge-dropout over a public SentencePiece merge model.

Only the pieces and their scores are taken from the model file.  A unit (a
word with the spaces before it) starts as characters; an agenda holds every
pair of neighbours that makes a piece, best score and leftmost first; each
candidate that comes up is skipped with probability ``dropout``, as a keyed
hash of seed, document, place of the unit in the document, unit and place in
the unit decides, and merged otherwise.  So every candidate is decided anew at
each occurrence of a word, and every result can be repeated from the seed.
Nothing that depends on the skips is remembered.

Many units are merged side by side: units of one length form a matrix with a
column for each, and a step takes the next candidate of every column.

Nothing is normalised: a character without a piece, and the space mark itself
where a text holds it, is written as byte pieces.  Decoding therefore gives
back any text exactly.

Documents are mapped where they lie, without a shuffle.  Defined results: null
and empty texts have no pieces; the document key of a null id is its text's
hash alone; repeated rows give equal results; an empty table gives no rows.
Only the named columns are read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .words import mix

SPACE = "▁"  # the mark of a space in pieces
DROPOUT = 0.1
AT_ONCE = 1 << 18  # characters of texts that are encoded together (a longer text is taken by itself)
CELLS = 1 << 16    # characters of units that are merged side by side
LONG = 64          # longer units take a priority queue each

_codecs: dict[tuple, "Codec"] = {}
_MASK = (1 << 64) - 1
_A, _B, _C = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xFF51AFD7ED558CCD
_FIRST, _LAST = (np.array([i * x & _MASK for i in range(LONG + 2)], np.uint64) for x in (_A, _B))
_POWER = np.array([pow(_A, i + 1, 1 << 64) for i in range(LONG)], np.uint64)
_NEVER = 1 << 30
_PLACES = 128      # a rank and a place in the unit as one number


class _Pairs:
    """Neighbouring symbols -> the piece they make, as a hash table in arrays."""

    def __init__(self, pairs: dict[tuple[int, int], int], symbols: int):
        self.symbols, self.none = np.int64(symbols), symbols
        self.shift = np.uint64(64 - max(4, (8 * len(pairs)).bit_length()))
        n = 1 << (64 - int(self.shift))
        # room behind the last slot, so that a probe never wraps around
        self.keys, self.piece = np.full(n + len(pairs) + 1, -1, np.int64), np.full(n + len(pairs) + 1, symbols, np.int32)
        key = np.array([a * symbols + b for a, b in pairs], np.int64)
        for k, at, piece in zip(key.tolist(), self._slot(key).tolist(), pairs.values()):
            while self.keys[at] >= 0:
                at += 1
            self.keys[at], self.piece[at] = k, piece

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return (key.view(np.uint64) * np.uint64(_A) >> self.shift).view(np.int64)

    def __call__(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The piece of each pair; ``none`` where there is none."""
        key = a * self.symbols + b
        at = self._slot(key)
        have = self.keys[at]
        out = np.where(have == key, self.piece[at], np.int32(self.none))
        rest = np.flatnonzero((have != key) & (have >= 0))
        key, at = key[rest], at[rest]
        while len(rest):
            at = at + 1
            have = self.keys[at]
            hit = have == key
            out[rest[hit]] = self.piece[at[hit]]
            on = ~hit & (have >= 0)
            rest, key, at = rest[on], key[on], at[on]
        return out


class Codec:
    def __init__(self, model: str, seed: int = 0, dropout: float = DROPOUT, at_once: int = AT_ONCE):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=model)
        self.seed, self.at_once = seed, at_once
        self.skip_below = int(dropout * 2**32)
        self.salt = xxhash.xxh64_intdigest(b"", seed=seed & _MASK)
        self.ids: dict[str, int] = {}
        self.bytes = np.zeros(256, np.int32)
        raw, scores = [], {}
        for i in range(sp.get_piece_size()):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.bytes[int(piece[3:5], 16)] = i
                raw.append(bytes([int(piece[3:5], 16)]))
            elif sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
                raw.append(b"")
            else:
                self.ids[piece] = i
                scores[piece] = sp.get_score(i)
                raw.append(piece.replace(SPACE, " ").encode())
        place = {x: i for i, x in enumerate(sorted(set(scores.values()), reverse=True))}
        self.rank = {piece: place[x] for piece, x in scores.items()}  # 0 is the best
        # a unit ends before a space mark that follows something else, and around line feeds,
        # as long as no piece reaches across
        if any(SPACE in p.lstrip(SPACE) or ("\n" in p and p != "\n") for p in self.ids):
            raise ValueError("pieces of this model reach across words")
        self.size = np.array([len(x) for x in raw], np.int64)
        self.at = np.concatenate([[0], np.cumsum(self.size)[:-1]])
        self.raw = np.frombuffer(b"".join(raw), np.uint8)
        # symbols: pieces by id, characters that only stand in longer pieces, and one for all other characters
        symbol = dict(self.ids)
        for c in sorted({c for p in self.ids for c in p} - set(symbol)):
            symbol[c] = len(raw) + len(symbol) - len(self.ids)
        self.pieces, self.other = len(raw), len(raw) + len(symbol) - len(self.ids)
        self.symbol = np.full(0x110000, self.other, np.int32)
        for c, x in symbol.items():
            if len(c) == 1:
                self.symbol[ord(c)] = x
        self.symbol[32], self.symbol[ord(SPACE)] = self.symbol[ord(SPACE)], self.other
        self.pair = _Pairs({(symbol[p[:i]], symbol[p[i:]]): x for p, x in self.ids.items() for i in range(1, len(p))
                            if p[:i] in symbol and p[i:] in symbol}, self.other + 1)
        self.order = np.full(self.other + 2, _NEVER, np.int32)
        for piece, x in self.ids.items():
            self.order[x] = self.rank[piece] * _PLACES

    def skipped(self, key: int, start: int, end: int) -> bool:
        """Keyed hash of a candidate merge: is it skipped?"""
        x = (key ^ (start * _A + end * _B)) & _MASK
        x = (x ^ (x >> 31)) * _C & _MASK
        return (x >> 32) < self.skip_below

    def occurrence(self, document: str, place: int) -> int:
        """Number of the unit that begins at a character (the space in front of the text is the first) of a document."""
        return xxhash.xxh64_intdigest(document, seed=self.seed & _MASK) + place * _B & _MASK

    def key(self, unit: str, occurrence: int) -> int:
        """Key of the skips of one occurrence of a unit."""
        x, power = occurrence + self.salt, 1
        for c in unit.replace(SPACE, " "):
            power = power * _A & _MASK
            x += ord(c) * power
        return int(mix(np.array([x & _MASK], np.uint64))[0])

    def segment(self, unit: str, occurrence: int) -> list[int]:
        """Ids of one occurrence of a unit (space marks instead of spaces) by the agenda."""
        codes = _codes(unit.replace(SPACE, " "))
        symbol, live = self.symbol[codes], np.ones(len(codes), bool)
        self._merge_units(codes, symbol, live, np.zeros(1, np.int64), np.array([len(codes)]), np.array([occurrence & _MASK], np.uint64))
        return self._ids(codes, symbol, live)[0].tolist()

    def _merge_units(self, codes, symbol, live, start, size, occurrence) -> None:
        """Merges the units ``codes[start:start + size]``: ``live`` keeps the first character of each symbol, ``symbol`` has it."""
        order = np.argsort(size, kind="stable")
        lengths, first = np.unique(size[order], return_index=True)
        for length, units in zip(lengths.tolist(), np.split(order, first[1:])):
            if length < 2:
                continue
            if length > LONG:
                for u in units.tolist():
                    lo = int(start[u])
                    self._merge_long(codes[lo:lo + length], symbol[lo:lo + length], live[lo:lo + length], int(occurrence[u]))
                continue
            step = max(1, CELLS // length)
            for lo in range(0, len(units), step):
                u = units[lo:lo + step]
                at = start[u] + np.arange(length)[:, None]
                symbol[at], live[at] = self._merge(codes[at], symbol[at], occurrence[u])

    def _merge(self, codes: np.ndarray, symbols: np.ndarray, occurrence: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """A column is a unit, a row a place in it: the symbols, and which places begin one."""
        length, n = symbols.shape
        below = np.uint64(self.skip_below)
        x = occurrence + np.uint64(self.salt)
        for p in range(length):
            x += codes[p] * _POWER[p]
        key = mix(x)
        # a row before and one behind the unit, which no pair has
        symbol = np.full((length + 2, n), self.other, np.int64)
        symbol[1:-1] = symbols
        place = np.arange(length + 2)[:, None]
        end, before = (np.broadcast_to(place + d, symbol.shape).astype(np.int16) for d in (1, -1))
        piece = np.full(symbol.shape, self.pair.none, np.int32)
        piece[:-1] = self.pair(symbol[:-1].ravel(), symbol[1:].ravel()).reshape(length + 1, n)
        # the agenda: rank and place of the pair that begins there
        agenda = self.order[piece] + place.astype(np.int32)
        table = agenda
        symbol, end, before, piece, agenda = (x.reshape(-1) for x in (symbol, end, before, piece, agenda))
        while True:
            best = table.min(axis=0)
            unit = np.flatnonzero(best < _NEVER)
            if not len(unit):
                break
            i = (best[unit] & (_PLACES - 1)).astype(np.int64)
            at_i = i * n + unit
            at_j = end[at_i] * np.int64(n) + unit
            k = end[at_j].astype(np.int64)
            if below:  # as ``skipped`` says, with places counted from the first character
                x = key[unit] ^ (_FIRST[i - 1] + _LAST[k - 1])
                skip = ((x ^ (x >> np.uint64(31))) * np.uint64(_C) >> np.uint64(32)) < below
                agenda[at_i[skip]] = _NEVER
                stay = np.flatnonzero(~skip)
                unit, i, at_i, at_j, k = unit[stay], i[stay], at_i[stay], at_j[stay], k[stay]
            at_k = k * n + unit
            made = piece[at_i].astype(np.int64)
            symbol[at_i], end[at_i], end[at_j], agenda[at_j], before[at_k] = made, k, 0, _NEVER, i
            found = self.pair(made, symbol[at_k])
            piece[at_i], agenda[at_i] = found, self.order[found] + i
            h = before[at_i].astype(np.int64)
            at_h = h * n + unit
            found = self.pair(symbol[at_h], made)
            piece[at_h], agenda[at_h] = found, self.order[found] + h
        return symbol.reshape(length + 2, n)[1:-1], end.reshape(length + 2, n)[1:-1] > 0

    def _merge_long(self, codes: np.ndarray, symbol: np.ndarray, live: np.ndarray, occurrence: int) -> None:
        """The same with a priority queue, for one unit of any length."""
        unit = _text(codes).replace(" ", SPACE)
        n, rank, below = len(unit), self.rank.get, self.skip_below
        key = self.key(unit, occurrence) if below else 0
        end = list(range(1, n + 1))       # of the symbol that starts here; 0 where none starts
        before = list(range(-1, n - 1))   # start of the symbol before
        agenda = [(r, i, i + 1, i + 2) for i in range(n - 1) if (r := rank(unit[i:i + 2])) is not None]
        heapify(agenda)
        while agenda:
            _, i, j, k = heappop(agenda)
            if end[i] != j or end[j] != k:
                continue  # one of the two was merged meanwhile
            if below and self.skipped(key, i, k):
                continue
            end[i], end[j] = k, 0
            if k < n:
                before[k] = i
                r = rank(unit[i:end[k]])
                if r is not None:
                    heappush(agenda, (r, i, k, end[k]))
            h = before[i]
            if h >= 0:
                r = rank(unit[h:k])
                if r is not None:
                    heappush(agenda, (r, h, i, k))
        for i, k in enumerate(end):
            live[i] = k > 0
            if k > i + 1:
                symbol[i] = self.ids[unit[i:k]]

    def _ids(self, codes, symbol, live) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all symbols, and how many come before each character; characters without a piece as bytes."""
        at = np.flatnonzero(live)
        found, c = symbol[at], codes[at]
        bare = found >= self.pieces
        count = np.ones(len(at), np.int64)
        if bare.any():
            count += bare * ((c >= 0x80).astype(np.int64) + (c >= 0x800) + (c >= 0x10000))
        out = np.repeat(found, count)
        if bare.any():
            out[np.repeat(bare, count)] = self.bytes[np.frombuffer(_text(c[bare]).encode("utf-8", "surrogatepass"), np.uint8)]
        before = np.zeros(len(codes) + 1, np.int64)
        before[at + 1] = count
        return out, np.cumsum(before)

    def encode_all(self, texts: list[str], documents: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of whole texts, one after the other, and where each text's begin."""
        # the texts as the model sees them: a space in front of each; marks of their own go as bytes
        codes = _codes("".join(" " + t for t in texts if t))
        at = np.concatenate([[0], np.cumsum([len(t) + 1 if t else 0 for t in texts])]).astype(np.int64)
        if not len(codes):
            return np.empty(0, np.int32), at
        space, alone = codes == 32, (codes == ord(SPACE)) | (codes == 10)
        begin = alone.copy()
        begin[1:] |= alone[:-1] | (space[1:] & ~space[:-1])
        begin[at[:-1][at[:-1] < len(codes)]] = True
        start = np.flatnonzero(begin)
        size = np.diff(start, append=len(codes))
        doc = np.searchsorted(at, start, side="right") - 1
        base = np.array([self.occurrence(d, 0) for d in documents], np.uint64)
        occurrence = base[doc] + (start - at[doc]).astype(np.uint64) * np.uint64(_B)
        symbol, live = self.symbol[codes], np.ones(len(codes), bool)
        self._merge_units(codes, symbol, live, start, size, occurrence)
        ids, before = self._ids(codes, symbol, live)
        return ids, before[at]

    def encode(self, text: str, document: str = "") -> np.ndarray:
        """Ids of a whole text."""
        return self.encode_all([text], [document])[0]

    def decode(self, ids: np.ndarray) -> bytes:
        """The text, in UTF-8."""
        n = self.size[ids]
        ends = np.cumsum(n)
        total = int(ends[-1]) if len(ends) else 0
        return self.raw[np.repeat(self.at[ids] - (ends - n), n) + np.arange(total)].tobytes()[1:]


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def _text(codes: np.ndarray) -> str:
    return codes.tobytes().decode("utf-32-le", "surrogatepass")


_UNIT = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")


def _units(line: str) -> list[str]:
    """A line cut before each run of spaces, with marks for spaces."""
    if not line:
        return []
    if "  " in line or line[-1] == " ":
        return _UNIT.findall(line.replace(" ", SPACE))
    first, *rest = line.split(" ")
    out = [SPACE + w for w in rest]
    return [first, *out] if first else out


def codec(model: str, seed: int, dropout: float) -> Codec:
    """One codec per worker and setting."""
    setting = (model, seed, dropout)
    if setting not in _codecs:
        _codecs[setting] = Codec(*setting)
    return _codecs[setting]


def _together(texts: list[str], most: int) -> Iterator[tuple[int, int]]:
    """Runs of texts with at most so many characters in all, one text at least."""
    lo = size = 0
    for i, text in enumerate(texts):
        if i > lo and size + len(text) > most:
            yield lo, i
            lo, size = i, 0
        size += len(text)
    if lo < len(texts):
        yield lo, len(texts)


def _rows(model: str, seed: int, dropout: float, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(model, seed, dropout)
        for batch in batches:
            keys, texts = batch.column("key").to_pylist(), batch.column("text").to_pylist()
            for lo, hi in _together(texts, own.at_once):
                ids, at = own.encode_all(texts[lo:hi], keys[lo:hi])
                digest, back, same = [], [], []
                for i, text in enumerate(texts[lo:hi]):
                    x = ids[at[i]:at[i + 1]]
                    y = own.decode(x)
                    digest.append(hashlib.sha256(x.astype("<u4").tobytes()).hexdigest())
                    back.append(hashlib.sha256(y).hexdigest())
                    same.append(y == text.encode())
                yield pa.record_batch({
                    "id": batch.column("id").slice(lo, hi - lo), "n_pieces": pa.array(np.diff(at), pa.int64()),
                    "ids_sha256": pa.array(digest, pa.string()), "decoded_sha256": pa.array(back, pa.string()),
                    "lossless": pa.array(same, pa.bool_()),
                    "ids": pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(ids, pa.int32())) if with_ids
                    else pa.nulls(hi - lo, pa.list_(pa.int32()))})
    return run


def encode_documents(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text", seed: int = 0,
                     dropout: float = DROPOUT, with_ids: bool = True) -> DataFrame:
    """Per row: id, ``n_pieces``, ``ids_sha256`` (ids as little-endian 32-bit), ``decoded_sha256``, ``lossless``, ``ids``.

    The decoded text is compared with the original; ``ids`` is null with ``with_ids=False``.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    text = F.coalesce(F.col(text_col), F.lit(""))
    one = docs.select(F.col(id_col).alias("id"), text.alias("text"),
                      F.coalesce(F.col(id_col).cast("string"), F.concat(F.lit("text "), F.xxhash64(text).cast("string"))).alias("key"))
    return one.mapInArrow(_rows(model, seed, dropout, with_ids),
                          f"id {kind}, n_pieces long, ids_sha256 string, decoded_sha256 string, lossless boolean, ids array<int>") \
        .withColumnRenamed("id", id_col)
