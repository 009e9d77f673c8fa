"""Benchmark decontamination: BM25 retrieval of test items for every training passage.

The test items form an inverted index (term -> items) in blocks of items, with
the largest impact of every term per block.  An impact is the item's BM25
weight of the term over ``share`` of the score that the item's own text would
get, so an item is retrieved when the impacts of the passage's terms reach 1.

Every text is cut into passages of twice the longest item (at least 64 words),
half overlapping, so each run of an item's length lies whole in some passage.
Passages are queries, taken a batch at a time by block-max WAND: the block
maxima of a passage's terms bound every score in a block; blocks whose bound
stays below 1 are skipped, the items of the others are scored exactly.  Terms
that very many items have enter the bounds as a constant and are only looked
up for the passages that remain.

A retrieved item is then verified: at least ``OVERLAP`` of the five-word
shingles of its question (the text but its last quarter) and of the words of
its answer (the last quarter, five words at least) must occur in the passage.

Items and texts are compared in lower case, by the full Unicode rule on both
sides (Spark's ``lower``).

The index travels with the tasks.  More than ``SHARD`` items are cut by hash
into shards, whose indexes are built by tasks from statistics over all items,
lie below the shared folder and are loaded by the tasks of one pass over the
documents each; scores and passages are those of a single index.  Documents
are mapped where they lie, without a shuffle.

Defined results: null and empty texts or items match nothing; an item shorter
than five words is verified by its whole word sequence; repeated items are
reported each by its id; repeated documents give repeated rows; empty tables
give no rows.  Only the named columns are read.
"""

from __future__ import annotations

import pickle
import uuid
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import work_dir
from .words import hash_words, mix, rolling, texts

K1, B = 1.2, 0.75
SHARE = 0.6      # of an item's own score that a passage must reach
OVERLAP = 0.8    # of the question's shingles and of the answer's words
SHINGLE = 5
BLOCK = 16       # items of a block
COMMON = 0.1     # terms of more than this share of the items are common
LEAST = 64       # fewest words of half a passage
SHARD = 20_000   # items of one index


def _hash_texts(items: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    raw = [(x or "").encode() for x in items]
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in raw])]).astype(np.int64)
    return hash_words(np.frombuffer(b"".join(raw), np.uint8), offsets)


class Statistics(NamedTuple):
    """Of all items with words: their number, mean and greatest length; of terms (in order), the items that have them."""
    n: int
    mean: float
    longest: int
    terms: np.ndarray
    df: np.ndarray


class Index:
    """Blocks, impacts and the words to verify of a list of items in lower case."""

    def __init__(self, items: list[str | None], share: float = SHARE, block: int = BLOCK,
                 over_all: Statistics | None = None):
        h, at = _hash_texts(items)
        size = np.diff(at)
        live = np.flatnonzero(size)
        # items of like length share blocks, which keeps the block maxima close to the impacts
        self.order = live[np.argsort(size[live], kind="stable")]
        self.block = block
        n = len(self.order)
        self.items = [h[at[i]:at[i + 1]] for i in self.order]
        self.terms, term = np.unique(np.concatenate([*self.items, np.empty(0, np.uint64)]), return_inverse=True)
        owner = np.repeat(np.arange(n), [len(x) for x in self.items])
        pair, tf = np.unique(term * np.int64(max(n, 1)) + owner, return_counts=True)
        term, owner = pair // max(n, 1), pair % max(n, 1)
        length = np.array([len(x) for x in self.items], float)
        if over_all is None:
            over_all = Statistics(n, length.mean() if n else 1.0, int(size.max()) if n else 0, self.terms,
                                  np.bincount(term, minlength=len(self.terms)))
        self.half = max(LEAST, over_all.longest)
        df = over_all.df[np.searchsorted(over_all.terms, self.terms)]
        idf = np.log1p((over_all.n - df + 0.5) / (df + 0.5))
        norm = K1 * (1 - B + B * length / over_all.mean)
        weight = idf[term] * tf * (K1 + 1) / (tf + norm[owner])
        own = np.bincount(owner, weights=weight, minlength=n)
        self.impact = weight / (share * own[owner])
        self.share = share
        # postings by term
        self.owner, self.post = owner, np.searchsorted(term, np.arange(len(self.terms) + 1))
        self.blocks = -(-n // block)
        cell, where = np.unique(term * np.int64(max(self.blocks, 1)) + owner // block, return_inverse=True)
        self.top = np.zeros(len(cell))
        np.maximum.at(self.top, where, self.impact)
        self.top_block = cell % max(self.blocks, 1)
        cell_term = cell // max(self.blocks, 1)
        self.tops = np.searchsorted(cell_term, np.arange(len(self.terms) + 1))
        self.common = df > max(8, COMMON * over_all.n)
        rare = ~self.common[cell_term]
        self.constant = np.bincount(self.top_block[~rare], weights=self.top[~rare], minlength=max(self.blocks, 1))
        self.table = np.zeros(1 << 16, bool)
        self.table[(self.terms >> np.uint64(48)).astype(np.int64)] = True
        self.question, self.answer = [], []
        for x in self.items:
            cut = len(x) - max(SHINGLE, len(x) // 4)
            if len(x) < SHINGLE:
                self.question.append(np.array([_sequence(x)]))
                self.answer.append(np.unique(x))
            else:
                # the question's shingles end inside the question where it has one
                own = rolling(x[:max(cut, SHINGLE)], SHINGLE)
                self.question.append(np.unique(own))
                self.answer.append(np.unique(x[max(cut, 0):]))

    def lookup(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of known words and their terms."""
        at = np.flatnonzero(self.table[(h >> np.uint64(48)).astype(np.int64)])
        t = np.searchsorted(self.terms, h[at])
        ok = self.terms[np.minimum(t, len(self.terms) - 1)] == h[at]
        return at[ok], t[ok]

    def retrieve(self, query: np.ndarray, term: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, item, score in impacts) of all items that reach 1, for ``n`` queries given as distinct (query, term) pairs."""
        none = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
        if not len(query):
            return none
        rare = ~self.common[term]
        q, t = query[rare], term[rare]
        row, at = _spread(self.tops, t)
        cell = q[row] * self.blocks + self.top_block[at]
        bound = np.bincount(cell, weights=self.top[at], minlength=n * self.blocks).reshape(n, self.blocks) + self.constant
        reached = bound >= 1 - 1e-9
        some = reached.any(1)
        if not some.any():
            return none
        keep = some[query]
        q, t = query[keep], term[keep]
        row, at = _spread(self.post, t)
        q, item, impact = q[row], self.owner[at], self.impact[at]
        keep = reached[q, item // self.block]
        key, where = np.unique(q[keep] * np.int64(len(self.items)) + item[keep], return_inverse=True)
        score = np.bincount(where, weights=impact[keep], minlength=len(key))
        hit = score >= 1 - 1e-9
        return key[hit] // len(self.items), key[hit] % len(self.items), score[hit]


def _sequence(words: np.ndarray) -> np.uint64:
    out = np.uint64(len(words))
    for w in words:
        out = mix(np.array([out * np.uint64(0x9E3779B97F4A7C15) + w]))[0]
    return out


def _spread(offsets: np.ndarray, t: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each t all places offsets[t] to offsets[t + 1]: the row of t and the place."""
    n = offsets[t + 1] - offsets[t]
    ends = np.cumsum(n)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(np.arange(len(t)), n), np.repeat(offsets[t] - (ends - n), n) + np.arange(total)


def _passages(size: np.ndarray, half: int) -> np.ndarray:
    """Passages of texts of so many words: starts at multiples of ``half``, twice as long, the last reaching the end."""
    return np.maximum(1, -(-size // half) - 1)


def search(index: Index, h: np.ndarray, at: np.ndarray) -> list[tuple[int, int, float, float, float]]:
    """Verified matches (text, item, score, question overlap, answer overlap), the best passage of each pair."""
    if not index.items or not len(h):
        return []
    size = np.diff(at)
    half = index.half
    n_of = _passages(size, half)
    first = np.concatenate([[0], np.cumsum(n_of)])
    place, term = index.lookup(h)
    doc = np.searchsorted(at, place, side="right") - 1
    local = (place - at[doc]) // half
    keys = []
    for k in (local, local - 1):
        ok = (k >= 0) & (k < n_of[doc])
        keys.append((first[doc[ok]] + k[ok]) * np.int64(len(index.terms)) + term[ok])
    key = np.unique(np.concatenate(keys))
    best: dict[tuple[int, int], tuple] = {}
    for q, item, score in zip(*(x.tolist() for x in index.retrieve(key // len(index.terms), key % len(index.terms), int(first[-1])))):
        d = int(np.searchsorted(first, q, side="right") - 1)
        lo = int(at[d]) + (q - int(first[d])) * half
        window = h[lo:min(lo + 2 * half, int(at[d + 1]))]
        x = index.items[item]
        if len(x) < SHINGLE:
            runs = [_sequence(window[i:i + len(x)]) for i in range(len(window) - len(x) + 1)]
            asked = float(np.isin(index.question[item], np.array(runs, np.uint64)).mean()) if runs else 0.0
        else:
            asked = float(np.isin(index.question[item], rolling(window, SHINGLE)).mean())
        told = float(np.isin(index.answer[item], window).mean())
        if asked >= OVERLAP and told >= OVERLAP:
            found = (asked + told, score * index.share, asked, told)
            best[d, item] = max(best.get((d, item), (-1.0,)), found)
    return [(d, item, *v[1:]) for (d, item), v in sorted(best.items())]


def _match_rows(load: Callable[[], tuple[pa.Array, Index]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        item_ids, index = load()
        for batch in batches:
            for lo, hi, data, offsets in texts(batch.column("text")):
                found = search(index, *hash_words(data, offsets))
                if found:
                    d, item, score, asked, told = map(list, zip(*found))
                    yield pa.record_batch({
                        "id": batch.column("id").take(pa.array([lo + x for x in d], pa.int64())),
                        "item": item_ids.take(pa.array(index.order[item], pa.int64())),
                        "score": pa.array(score, pa.float64()), "asked": pa.array(asked, pa.float64()),
                        "told": pa.array(told, pa.float64())})
    return run


def _clean_rows(load: Callable[[], tuple[pa.Array, Index]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, index = load()
        for batch in batches:
            keep = np.ones(batch.num_rows, bool)
            for lo, _, data, offsets in texts(batch.column("text")):
                for d, *_ in search(index, *hash_words(data, offsets)):
                    keep[lo + d] = False
            yield batch.filter(pa.array(keep))  # with the lower-case text, for the next index
    return run


def _term_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(shard, term, items that have it) of each batch of items, and a row without a term per item: its length."""
    for batch in batches:
        h, at = _hash_texts(batch.column("text").to_pylist())
        size, k = np.diff(at), batch.column("k").to_numpy()
        pairs = np.unique(np.stack([np.repeat(np.arange(len(size)), size), h.view(np.int64)], 1), axis=0)
        live = np.flatnonzero(size)
        yield pa.record_batch({
            "k": pa.array(np.concatenate([k[pairs[:, 0]], k[live]]), pa.int32()),
            "h": pa.array([*pairs[:, 1].tolist(), *[None] * len(live)], pa.int64()),
            "n": pa.array(np.concatenate([np.ones(len(pairs), np.int64), size[live]]), pa.int64())})


def _write_shard(folder: str, n: int, mean: float, longest: int):
    def run(key: tuple, items: pa.Table, counts: pa.Table) -> pa.Table:
        items = items.sort_by([("id", "ascending"), ("text", "ascending")])
        terms = counts.column("h").to_numpy().view(np.uint64)
        order = np.argsort(terms)
        index = Index(items.column("text").to_pylist(),
                      over_all=Statistics(n, mean, longest, terms[order], counts.column("df").to_numpy()[order]))
        where, root = fs.FileSystem.from_uri(folder)
        where.create_dir(root)
        # a name of its own for every attempt; the row returned says which one counts
        name = f"{uuid.uuid4().hex}.index"
        with where.open_output_stream(f"{root}/{name}") as out:
            pickle.dump((items.column("id").combine_chunks(), index), out, protocol=5)
        return pa.table({"name": [name]})
    return run


def _loader(folder: str, name: str) -> Callable[[], tuple[pa.Array, Index]]:
    def load():
        where, root = fs.FileSystem.from_uri(folder)
        with where.open_input_stream(f"{root}/{name}") as file:
            return pickle.loads(file.readall())
    return load


def _shards(items: DataFrame, id_col: str, text_col: str, shard: int) -> list[Callable[[], tuple[pa.Array, Index]]]:
    """What tasks call for ids and index of at most about ``shard`` items each."""
    one = items.select(F.col(id_col).alias("id"), F.lower(F.col(text_col)).alias("text"))
    n = one.count()
    if not n:
        return []
    if n <= shard:
        table = one.orderBy("id", "text").toArrow()
        held = table.column("id").combine_chunks(), Index(table.column("text").to_pylist())
        return [lambda: held]
    spark = items.sparkSession
    at = work_dir(spark, "decontaminate")
    cut = one.withColumn("k", F.pmod(F.xxhash64("id", "text"), F.lit(-(-n // shard))).cast("int"))
    cut.select("k", "text").mapInArrow(_term_rows, "k int, h long, n long").write.parquet(f"{at}/terms")
    terms = spark.read.parquet(f"{at}/terms")
    live, total, longest = terms.where("h is null").agg(F.count("n"), F.sum("n"), F.max("n")).first()
    if not live:
        return []
    df = terms.where("h is not null").groupBy("h").agg(F.sum("n").alias("df"))
    counts = terms.where("h is not null").select("k", "h").distinct().join(df, "h").select("k", "h", "df")
    made = cut.where(F.col("text").isNotNull()).groupBy("k").cogroup(counts.groupBy("k")).applyInArrow(
        _write_shard(f"{at}/shards", live, total / live, longest), "name string")
    return [_loader(f"{at}/shards", r.name) for r in made.collect()]


def matches(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id",
            item_text_col: str = "text", shard: int = SHARD) -> DataFrame:
    """One row per document and test item found in it: both ids, ``score`` (share of the item's own), ``question_overlap``, ``answer_overlap``."""
    one = docs.select(F.col(id_col).alias("id"), F.lower(F.coalesce(F.col(text_col), F.lit(""))).alias("text"))
    kind, item_kind = (x.schema[c].dataType.simpleString() for x, c in ((docs, id_col), (items, item_id_col)))
    schema = f"id {kind}, item {item_kind}, score double, asked double, told double"
    out = None
    for load in _shards(items, item_id_col, item_text_col, shard):
        part = one.mapInArrow(_match_rows(load), schema)
        out = part if out is None else out.unionByName(part)
    if out is None:
        out = docs.sparkSession.createDataFrame([], schema)
    return out.select(F.col("id").alias(id_col), F.col("item").alias(item_id_col), "score",
                      F.col("asked").alias("question_overlap"), F.col("told").alias("answer_overlap"))


def clean(docs: DataFrame, items: DataFrame, text_col: str = "text", item_id_col: str = "item_id",
          item_text_col: str = "text", shard: int = SHARD) -> DataFrame:
    """``docs``, all columns, without the documents that hold a test item."""
    # the columns ride along as one beside the text in lower case
    both = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), F.lower(F.col(text_col)).alias("text"))
    for load in _shards(items, item_id_col, item_text_col, shard):
        both = both.mapInArrow(_clean_rows(load), both.schema)
    return both.select(*(F.col("row").getField(c).alias(c) for c in docs.columns))
