"""Removal of repeated passages by prefix-partitioned suffix trees.

A word goes when a window of ``WINDOW`` consecutive words that covers it also
starts somewhere else, in the same or another document.

Only suffixes at *anchors* enter the trees.  Of the ``GRAM``-word prefixes
inside a window the one with the least hash marks an anchor, so equal windows
have an anchor at the same place and every repeat passes through a pair of
anchored suffixes with an equal prefix; about one word in ten is an anchor.

1. Anchors (prefix hash, document, place) are partitioned by their prefix.
   A prefix met once ends there.
2. An anchored suffix with a repeated prefix is cut from its text: the words
   up to the end of the windows it stands for, and those before it.
3. Suffixes are partitioned by prefix.  The prefix is ``GRAM`` words long
   where that leaves a group of at most ``GROUP`` suffixes, else the whole
   window, whose groups need only be counted.  Each group is one subtree: its
   suffixes sorted, with the longest common prefixes between neighbours; an
   internal node of depth r is a run of suffixes with common prefixes of r
   words and more.  Where such a node and a node of the tree of the words
   before the anchor (depth l, r + l = ``WINDOW``) share two leaves, the
   window of l words before and r words after is repeated.
4. The marks go back to their documents and the covered words go.

Copies of a whole text are found first (by text hash): one of them stands in
the trees for all, and all lose every word if there are ``WINDOW`` of them.
Documents travel by a hash of id and text, so neither a hot text nor a hot
source lands in one task.  Words and texts are compared by 64-bit hash.

Defined results: a null text has no words; a text shorter than the window
keeps all; rows that repeat an (id, text) count as several documents; null
ids are kept; an empty table gives no rows.  Only the named columns are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .words import hash_words, rolling, slide, texts

WINDOW = 35
GRAM = 16
GROUP = 20_000  # suffixes of a group that one task holds; a context is at most 8 * (2 * WINDOW - GRAM) bytes


class _Layout:
    """Words, anchors and windows of a slice of documents."""

    def __init__(self, data, offsets, window, gram):
        self.words, self.at = hash_words(data, offsets)
        n = len(self.words)
        self.span = span = window - gram + 1  # prefixes that lie in a window
        counts = np.diff(self.at)
        self.doc = np.repeat(np.arange(len(counts)), counts)
        place = np.arange(n) - self.at[:-1][self.doc]
        left = counts[self.doc] - place  # words from here to the end of the text
        self.place = place
        if n < window:
            self.prefix = self.least = np.empty(0, np.uint64)
            self.whole = np.empty(0, bool)
            return
        top = np.uint64(2**64 - 1)
        self.prefix = rolling(self.words, gram)
        self.whole = left[:n - window + 1] >= window
        self.least = slide(np.minimum(self.prefix, top - np.uint64(1)), span)[:n - window + 1]
        self.prefix = np.minimum(self.prefix, top - np.uint64(1))

    def anchors(self) -> np.ndarray:
        """Places whose prefix is the least one of a whole window."""
        m = len(self.least)
        if not m:
            return np.empty(0, np.int64)
        # the greatest of the least values of the windows that hold a place; windows across texts count nothing
        least = np.where(self.whole, self.least, np.uint64(0))
        pad = np.zeros(self.span - 1, np.uint64)
        best = slide(np.concatenate([pad, least, pad]), self.span, least=False)
        return np.flatnonzero((best == self.prefix[:len(best)]) & (best > 0))

    def owned(self, p: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First and last start of the windows that each anchor stands for; whether there are any."""
        s = p[:, None] - np.arange(self.span)[::-1]
        m = len(self.least)
        inside = (s >= 0) & (s < m)
        c = np.where(inside, s, 0)
        own = inside & self.whole[c] & (self.least[c] == self.prefix[p][:, None])
        return p - (self.span - 1) + own.argmax(1), p - own[:, ::-1].argmax(1), own.any(1)


def _by_text(h: np.ndarray, at: np.ndarray, lay: _Layout, ids: np.ndarray) -> pa.RecordBatch:
    """One row per hash and text with all its places ``at``, so that a text of one word over and over is no hot key."""
    order = np.lexsort((at, h, lay.doc[at]))
    h, at = h[order], at[order]
    new = np.ones(len(at), bool)
    new[1:] = (h[1:] != h[:-1]) | (lay.doc[at[1:]] != lay.doc[at[:-1]])
    first = np.flatnonzero(new)
    places = pa.ListArray.from_arrays(pa.array(np.append(first, len(at)).astype(np.int32)),
                                      pa.array(lay.place[at].astype(np.int32)))
    return pa.record_batch({"h": h[first].view(np.int64), "u": ids[lay.doc[at[first]]], "places": places})


def _anchor_rows(window: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("u").to_numpy(zero_copy_only=False)
            for lo, hi, data, offsets in texts(batch.column("text")):
                lay = _Layout(data, offsets, window, gram)
                p = lay.anchors()
                yield _by_text(lay.prefix[p], p, lay, ids[lo:hi])
    return run


def _flat(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """Values and offsets of a list column (nulls as empty lists)."""
    lens = np.asarray(column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False), np.int64)
    return column.flatten(), np.concatenate([[0], np.cumsum(lens)])


def _suffix_rows(window: int, gram: int, whole_windows: bool):
    """Suffixes with the words around them; or, one row per text and hash of all words of a window, the windows' places."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("u").to_numpy(zero_copy_only=False)
            flat, at = _flat(batch.column("places"))
            flat = flat.to_numpy(zero_copy_only=False)
            for lo, hi, data, offsets in texts(batch.column("text")):
                lay = _Layout(data, offsets, window, gram)
                k = np.diff(at[lo:hi + 1])
                p = flat[at[lo]:at[hi]] + np.repeat(lay.at[:-1], k)
                if not len(p):
                    continue
                first, last, any_ = lay.owned(p)
                p, first, last = p[any_], first[any_], last[any_]
                if whole_windows:
                    n = last - first + 1
                    s = np.repeat(first - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
                    s = np.unique(s)  # a window that holds two anchors counts once
                    yield _by_text(rolling(lay.words, window)[s], s, lay, ids[lo:hi])
                    continue
                u = ids[lo:hi][lay.doc[p]]
                step = 8192
                for i in range(0, len(p), step):
                    j = slice(i, i + step)
                    n = last[j] - first[j] + window
                    ends = np.cumsum(n)
                    body = lay.words[np.repeat(first[j] - np.concatenate([[0], ends[:-1]]), n) + np.arange(ends[-1])]
                    words = pa.Array.from_buffers(pa.binary(), len(n), [
                        None, pa.py_buffer(np.concatenate([[0], ends * 8]).astype(np.int32)), pa.py_buffer(body)])
                    yield pa.record_batch({
                        "h": lay.prefix[p[j]].view(np.int64), "u": u[j], "place": lay.place[p[j]].astype(np.int32),
                        "before": (p[j] - first[j]).astype(np.int32), "words": words})
    return run


def _runs(rows: np.ndarray, lens: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the rows as a sorted suffix list, and the words that each has in common with the one before it."""
    keyed = np.ascontiguousarray(np.concatenate([group[:, None], rows], axis=1))
    order = np.argsort(keyed.view(np.dtype((np.void, keyed.shape[1] * 8))).ravel(), kind="stable")
    a = keyed[order]
    same = a[1:] == a[:-1]
    common = np.logical_and.accumulate(same, axis=1).sum(axis=1) - 1  # -1: another group
    lens = lens[order]
    common = np.where(common < 0, -1, np.minimum(common, np.minimum(lens[1:], lens[:-1])))
    return order, np.concatenate([[-1], common])


def repeated_windows(group: np.ndarray, before: np.ndarray, counts: np.ndarray, flat: np.ndarray,
                     window: int = WINDOW, gram: int = GRAM) -> np.ndarray:
    """Per suffix a bit set: bit l says that the window starting l words before the anchor is repeated.

    ``group`` is the prefix of each suffix, ``flat`` the words of all rows one
    after another (``counts`` each), ``before`` how many stand before the anchor.
    """
    n, span = len(group), window - gram + 1
    at = np.concatenate([[0], np.cumsum(counts)[:-1]])
    after = counts - before

    def grid(width, have, index):
        j = np.arange(width)[None, :]
        ok = j < have[:, None]
        return np.where(ok, flat[np.where(ok, index(j), 0)], np.uint64(0))

    forward = grid(window, after, lambda j: (at + before)[:, None] + j)
    backward = grid(span - 1, before, lambda j: (at + before)[:, None] - 1 - j) if span > 1 else np.zeros((n, 1), np.uint64)
    order_f, common_f = _runs(forward, after, group)
    order_b, common_b = _runs(backward, before, group)
    mask = np.zeros(n, np.int64)
    node_f, node_b = np.empty(n, np.int64), np.empty(n, np.int64)
    for l in range(span):
        r = window - l
        node_f[order_f] = np.cumsum(common_f < r)   # the node of depth r above each leaf
        node_b[order_b] = np.cumsum(common_b < l)
        use = np.flatnonzero((before >= l) & (after >= r))
        if not len(use):
            continue
        key = node_f[use] * np.int64(n + 1) + node_b[use]
        _, which, times = np.unique(key, return_inverse=True, return_counts=True)
        mask[use[times[which] > 1]] |= np.int64(1) << np.int64(l)
    return mask


def _subtree_rows(window: int, gram: int, at_once: int = 16_000):
    """Groups of a partition sorted by prefix, a bounded number of suffixes at a time."""
    def solve(table: pa.Table) -> pa.RecordBatch:
        words = table.column("words").combine_chunks()
        words = words.chunk(0) if isinstance(words, pa.ChunkedArray) else words
        offsets = np.frombuffer(words.buffers()[1], np.int32)[words.offset:words.offset + len(words) + 1].astype(np.int64)
        flat = np.frombuffer(words.buffers()[2], np.uint64, count=int(offsets[-1]) // 8)
        flat = flat[offsets[0] // 8:]
        group = table.column("h").to_numpy().view(np.uint64)
        mask = repeated_windows(group, table.column("before").to_numpy().astype(np.int64), np.diff(offsets) // 8, flat,
                                window, gram)
        hit = mask > 0
        return pa.record_batch({"u": table.column("u").to_numpy()[hit], "place": table.column("place").to_numpy()[hit],
                                "mask": mask[hit]})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            n += batch.num_rows
            if n < at_once:
                continue
            table = pa.Table.from_batches(held)
            h = table.column("h").to_numpy()
            cut = int(np.searchsorted(h, h[-1]))  # the last group may go on
            if cut:
                yield solve(table.slice(0, cut))
                held = table.slice(cut).combine_chunks().to_batches()
                n -= cut
        if n:
            yield solve(pa.Table.from_batches(held))
    return run


def _kept_rows(window: int, words_only: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, copied = batch.column("id"), batch.column("copied").to_pylist()
            col = batch.column("text").cast(pa.large_binary())
            marks, at = _flat(batch.column("marks"))
            place = marks.field("place").to_numpy(zero_copy_only=False)
            mask = marks.field("mask").to_numpy(zero_copy_only=False)
            lo, size = 0, 0
            out = {"n_words": [], "n_removed": [], "kept_sha256": [], "kept_text": []}
            for i, text in enumerate(col):
                raw = text.as_py() or b""
                size += len(raw)
                words = raw.split()  # bytes.split() parts at \x20 and \x09 to \x0D only
                n, gone = len(words), 0
                kept = words
                if copied[i] and n >= window:
                    kept, gone = [], n
                elif at[i] < at[i + 1]:
                    cover = np.zeros(n + 1, np.int64)
                    m = mask[at[i]:at[i + 1]]
                    p = place[at[i]:at[i + 1]].astype(np.int64)
                    for l in range(int(m.max()).bit_length()):
                        s = p[(m >> l) & 1 == 1] - l
                        np.add.at(cover, s, 1)
                        np.add.at(cover, s + window, -1)
                    stay = np.cumsum(cover[:n]) == 0
                    gone = int(n - stay.sum())
                    kept = [words[j] for j in np.flatnonzero(stay)]
                joined = b" ".join(kept)
                out["n_words"].append(n)
                out["n_removed"].append(gone)
                out["kept_sha256"].append(hashlib.sha256(joined).hexdigest())
                # a text that loses nothing keeps its white space
                out["kept_text"].append(None if words_only else (joined if gone else raw))
                if size > 1 << 23 or i == len(col) - 1:
                    yield pa.record_batch({
                        "id": ids.slice(lo, i + 1 - lo), "n_words": pa.array(out["n_words"], pa.int64()),
                        "n_removed": pa.array(out["n_removed"], pa.int64()), "kept_sha256": pa.array(out["kept_sha256"], pa.string()),
                        "kept_text": pa.array(out["kept_text"], pa.binary()).cast(pa.string())})
                    out = {k: [] for k in out}
                    lo, size = i + 1, 0
    return run


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                   gram: int = GRAM, group: int = GROUP, with_text: bool = True) -> DataFrame:
    """One row per input row: id, ``n_words``, ``n_removed``, ``kept_sha256``, ``kept_text``.

    ``kept_text`` is the kept words joined by one space, or the text as it was
    where nothing goes (null with ``with_text=False``).  ``gram`` is the short
    prefix length, under ``window``; ``group`` the most suffixes of a subtree.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    id_type = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), text.alias("text")) \
        .withColumn("k", F.xxhash64("text")).withColumn("u", F.xxhash64("id", "text"))
    # copies of a text: all rows of a text that more than one row has; the least u stands for them
    groups = rows.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.min("u").alias("lead")).where("n > 1")
    copies = rows.select("k", "u").join(groups, "k").select("u", (F.col("u") == F.col("lead")).alias("leads")).distinct()
    # every branch below takes all three columns of ``spread``, so its texts are shuffled once and reused
    spread = rows.select("u", "id", "text").repartition("u")
    known = spread.join(copies, "u", "left")
    lead = known.where("leads is null or leads").select("u", "id", "text")

    anchors = lead.mapInArrow(_anchor_rows(window, gram), "h long, u long, places array<int>")
    # suffixes of a prefix are counted where they arise; what is joined back is one row a prefix, so a prefix that
    # much of the corpus holds is no window of one task
    shared = anchors.groupBy("h").agg(F.sum(F.size("places")).alias("c")).where("c > 1")
    counted = anchors.join(shared, "h")

    def with_places(part: DataFrame) -> DataFrame:
        per_text = part.groupBy("u").agg(F.sort_array(F.flatten(F.collect_list("places"))).alias("places"))
        return spread.join(per_text, "u")

    suffixes = with_places(counted.where(F.col("c") <= group)).mapInArrow(
        _suffix_rows(window, gram, False), "h long, u long, place int, before int, words binary")
    marks = suffixes.repartition("h").sortWithinPartitions("h").mapInArrow(
        _subtree_rows(window, gram), "u long, place int, mask long")
    # prefixes too common for one task: their windows by the prefix of full length, counted before they meet; a passage
    # that goes round within many texts makes one row a text and window, however often it is there
    full = with_places(counted.where(F.col("c") > group)).mapInArrow(
        _suffix_rows(window, gram, True), "h long, u long, places array<int>").distinct()
    again = full.groupBy("h").agg(F.sum(F.size("places")).alias("n")).where("n > 1").select("h")
    marks = marks.select("u", F.array(F.struct("place", "mask")).alias("marks")).unionByName(full.join(again, "h").select(
        "u", F.transform("places", lambda p: F.struct(p.alias("place"), F.lit(1).cast("long").alias("mask"))).alias("marks")))
    per_text = marks.groupBy("u").agg(F.flatten(F.collect_list("marks")).alias("marks"))
    out = known.join(per_text, "u", "left").select(
        "id", "text", F.col("leads").isNotNull().alias("copied"), "marks").mapInArrow(
        _kept_rows(window, not with_text),
        f"id {id_type}, n_words long, n_removed long, kept_sha256 string, kept_text string")
    return out.withColumnRenamed("id", id_col)
