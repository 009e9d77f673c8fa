"""Exact Jaccard join of documents as word-shingle sets, by a partitioned universe.

Two sets with similarity ``num / den`` or more differ in few tokens: for a
larger set of n tokens in at most d(n) = 2n (den - num) / (den + num).  The
universe of tokens is hashed into segments, and a pair that differs in d
tokens must, for any allocation v of -1, 0 or 1 to the segments with
sum(v + 1) > d, differ by at most v in some segment.

* Sets are put in size bands, each with as many segments as its largest
  difference needs and some to spare; a set is indexed in its own band and,
  where a larger partner could stand there, in the next.
* The index holds the subset of every segment and, for one reserve segment,
  its neighbourhood: the subset less one token, so that a difference of one
  token still meets there.
* The allocation takes v = 0 for the plain segments and v = 1 for the reserve.
  Its cost is what the lists of equal keys hold: a set whose segments without
  company (cost nothing) already carry the sum over d has no partner, so it is
  a candidate only if the segments it shares, the reserve counted twice, reach
  what is left: sum(v + 1) - d.  Empty subsets, which say nothing, count as
  shared without being listed, unless they alone could carry the rest.

A text is cut into words once.  Its keys travel packed, as arrays of the keys
of many texts by cell (a range of keys), and a cell is sorted in one piece to
find the keys that more than one set has; only those become rows.

Candidates are never listed as pairs: a bucket of equal keys ties its
candidates to the least one, components of these ties are the groups, and
each group is verified on the sets themselves.  A group too large for a task
is cut into blocks and verified block by block.  Within a task a set that is
already tied to all others is not compared again, so a group of copies around
one original takes one comparison each.

Equal sets count as one from the start.  Tokens and sets are compared by
64-bit hash.

Defined results: a null or wordless text has an empty set and is linked with
nothing; a text with fewer words than a shingle has one token, its word
sequence; rows that repeat an id and text stay rows; null ids form components
like others but cannot name one (the least non-null id does); an empty table
gives no rows.  Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import work_dir
from .components import components
from .words import hash_words, mix, rolling, texts

SHINGLE = 3
NUM, DEN = 90, 100
BAND_GROWTH = 1.5
SPARE = 0.25          # segments to spare, as a share of the largest difference of a band
BLOCK = 2_000_000     # tokens of a block: 16 MB
RECENT = 200_000      # sets whose copies a task does not index again
CELL = 1_000_000      # keys of a cell, about
FEWEST = 10_000       # keys of a cell where they are dealt to more tasks
SPREAD = 4            # cells of a task then, so that tasks come out even
PACK = 1_000_000      # keys that a task packs at once
GATHER = 2_000_000    # keys of a cell that are compared at once


def _sets(data, offsets, shingle: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct tokens of each text of a slice, in order: tokens, their text, where each text begins."""
    h, at = hash_words(data, offsets, fold=True)
    n = np.diff(at)
    grams = rolling(h, shingle)
    size = np.where(n < shingle, n > 0, n - shingle + 1)
    begin = np.concatenate([[0], np.cumsum(size)])
    token = np.empty(begin[-1], np.uint64)
    owner = np.repeat(np.arange(len(n)), size)
    if len(grams):
        doc = np.repeat(np.arange(len(n)), n)
        token[n[owner] >= shingle] = grams[doc[:len(grams)] == doc[shingle - 1:]]
    for width in range(1, shingle):  # shorter texts: one token of their own kind
        few = np.flatnonzero(n == width)
        if len(few):
            token[begin[few]] = mix(rolling(h, width)[at[few]] + np.uint64(width))
    # text by text: sorting values takes a fraction of sorting their places
    for i in np.flatnonzero(size > 1).tolist():
        token[begin[i]:begin[i + 1]].sort()
    if len(token):
        new = np.concatenate([[True], (token[1:] != token[:-1]) | (owner[1:] != owner[:-1])])
        token, owner = token[new], owner[new]
    return token, owner, np.searchsorted(owner, np.arange(len(n) + 1))


def _sums(x: np.ndarray, bins: np.ndarray, n: int) -> np.ndarray:
    """Sums modulo 2**64 by bin (exact: each half stays below 2**53 for under two million values a bin)."""
    lo = np.bincount(bins, weights=(x & np.uint64(0xFFFFFFFF)).astype(np.float64), minlength=n)
    hi = np.bincount(bins, weights=(x >> np.uint64(32)).astype(np.float64), minlength=n)
    return lo.astype(np.uint64) + (hi.astype(np.uint64) << np.uint64(32))


def _signatures(token, owner, n: int) -> tuple[np.ndarray, np.ndarray]:
    size = np.bincount(owner, minlength=n)
    return size, mix(_sums(mix(token), owner, n) + size.astype(np.uint64))


class Bands:
    """Size bands and the number of segments of each."""

    def __init__(self, num: int = NUM, den: int = DEN):
        self.num, self.den = num, den
        tops = [max(1, (den + num) // (2 * (den - num)))]
        while tops[-1] < 2**40:
            tops.append(max(tops[-1] + 1, int(tops[-1] * BAND_GROWTH)))
        self.top = np.array(tops, np.int64)
        self.low = np.concatenate([[1], self.top[:-1] + 1])
        # sum(v + 1) over the segments: one by one but for the reserve, which has v = 1
        most = self.apart(self.top, self.top)
        self.units = np.maximum(2, most + 1 + (SPARE * most).astype(np.int64))
        self.segments = self.units - 1

    def apart(self, a, b):
        """Most tokens in which linked sets of sizes ``a`` and ``b`` can differ."""
        return (a + b) * (self.den - self.num) // (self.den + self.num)

    def memberships(self, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(set, band, is it the band of the set): where each set is indexed."""
        own = np.searchsorted(self.top, size)
        sets, bands, home = [np.flatnonzero(size > 0)], [own[size > 0]], [np.ones(int((size > 0).sum()), bool)]
        step = 1
        while True:
            b = np.minimum(own + step, len(self.top) - 1)
            more = np.flatnonzero((size > 0) & (b == own + step) & (self.low[b] * self.num <= size * self.den))
            if not len(more):
                break
            sets.append(more), bands.append(b[more]), home.append(np.zeros(len(more), bool))
            step += 1
        return np.concatenate(sets), np.concatenate(bands), np.concatenate(home)


HOME, NEAR = 2, 1  # bits of a row's mark below its band: the set's own band; a key of the reserve segment


def keys(token: np.ndarray, at: np.ndarray, bands: Bands) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(key, set, mark, need) rows for the sets ``token[at[i]:at[i+1]]``; ``need``: units to share beside empty segments."""
    size = np.diff(at)
    sets, band, home = bands.memberships(size)
    # in band 0 no two different sets are linked, and nothing is looked up there
    use = band > 0
    sets, band, home = sets[use], band[use], home[use]
    if not len(sets):
        return np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int32), np.empty(0, np.int32)
    m = bands.segments[band]
    first = np.concatenate([[0], np.cumsum(m)])
    cells = int(first[-1])
    n = size[sets]
    ends = np.cumsum(n)
    member = np.repeat(np.arange(len(sets)), n)
    x = token[np.repeat(at[sets] - (ends - n), n) + np.arange(ends[-1])]
    spread = mix(x + band[member].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    seg = ((spread >> np.uint64(32)) * m[member].astype(np.uint64) >> np.uint64(32)).astype(np.int64)
    cell = first[member] + seg
    value = mix(x)
    total = _sums(value, cell, cells)
    count = np.bincount(cell, minlength=cells)
    cell_member = np.repeat(np.arange(len(sets)), m)
    cell_seg = np.arange(cells) - first[cell_member]
    place = mix((band[cell_member] << 32 | cell_seg).astype(np.uint64) + np.uint64(1))
    exact = mix(total + place)

    largest = np.minimum(bands.top[band], n * bands.den // bands.num)  # of a partner in this band
    need = bands.units[band] - bands.apart(n, largest)
    zero = first[:-1]
    # segments that count as shared: empty ones, and the reserve with a token or none
    given = np.bincount(cell_member, weights=(count == 0) & (cell_seg > 0), minlength=len(sets)).astype(np.int64)
    need = need - given - 2 * (count[zero] < 2)
    listed = need <= 0  # these could be all that a pair shares, so they are listed after all
    mark = (band << 2 | np.where(home, HOME, 0)).astype(np.int32)

    plain = np.flatnonzero((cell_seg > 0) & ((count > 0) | listed[cell_member]))
    reserve = zero[(count[zero] > 0) | listed]
    in_zero = np.flatnonzero(seg == 0)
    in_zero = in_zero[(count[zero[member[in_zero]]] > 1) | listed[member[in_zero]]]
    zm = member[in_zero]
    less = mix(total[zero[zm]] - value[in_zero] + place[zero[zm]])
    of = np.concatenate([cell_member[plain], cell_member[reserve], zm])
    near = np.repeat(np.array([0, NEAR], np.int32), [len(plain), len(reserve) + len(zm)])
    return (np.concatenate([exact[plain], exact[reserve], less]), sets[of], mark[of] | near, need[of].astype(np.int32))


def _index_rows(shingle: int, num: int, den: int, cells: int):
    """Two kinds of rows: a text's id, ``u``, number of tokens and set; and, packed by cell, the keys of many sets."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands, recent, held, n = Bands(num, den), set(), [], 0
        for batch in batches:
            id_type = batch.column("id").type
            for lo, hi, data, offsets in texts(batch.column("text")):
                token, owner, at = _sets(data, offsets, shingle)
                size, sig = _signatures(token, owner, hi - lo)
                u = batch.column("u").slice(lo, hi - lo)
                cell = np.asarray(u).view(np.uint64) % np.uint64(cells)
                yield _packed(cell.astype(np.int32), np.full(hi - lo, TEXT, np.int32), {
                    "id": batch.column("id").slice(lo, hi - lo), "u": u, "n_shingles": size.astype(np.int64),
                    "set": sig.view(np.int64)}, id_type)
                # equal sets are indexed once by a task
                new = []
                for i, x in enumerate(sig.tolist()):
                    if x not in recent:
                        recent.add(x)
                        new.append(i)
                if len(recent) > RECENT:
                    recent.clear()
                size = np.diff(at)[new]
                ends = np.cumsum(size)
                if not len(new) or not ends[-1]:
                    continue
                mine = token[np.repeat(at[new] - (ends - size), size) + np.arange(ends[-1])]
                key, which, mark, need = keys(mine, np.concatenate([[0], ends]), bands)
                held.append((key, sig.view(np.int64)[new][which], mark, need))
                n += len(key)
                if n >= PACK:
                    yield _by_cell(held, cells, id_type)
                    held, n = [], 0
        if n:
            yield _by_cell(held, cells, id_type)
    return run


def _by_cell(held: list, cells: int, id_type: pa.DataType) -> pa.RecordBatch:
    """Keys as one row a cell and part, where there are any: the rows of each are arrays of bytes."""
    columns = [np.concatenate(x) for x in zip(*held)]
    key, _, mark, _ = columns
    cell = ((key >> np.uint64(32)) * np.uint64(cells) >> np.uint64(32)).astype(np.int64)
    code = cell * 2 + (mark & HOME == 0)
    if cells < 1 << 15:
        code = code.astype(np.uint16)  # sorted by radix
    order = np.argsort(code, kind="stable")
    code = code[order]
    first = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]]))
    ends = np.concatenate([first, [len(code)]])
    part = code[first].astype(np.int32)

    def packed(x: np.ndarray) -> pa.Array:
        offsets = (ends * x.itemsize).astype(np.int32)
        return pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(offsets), pa.py_buffer(x[order])])

    return _packed(part // 2, part % 2, dict(zip(PACKED, map(packed, columns))), id_type)


HOMES, AWAY, TEXT = range(3)  # parts of a cell, in order: keys in the own bands of their sets, other keys, texts
PACKED = {"key": np.uint64, "sig": np.int64, "mark": np.int32, "need": np.int32}


def _packed(cell: np.ndarray, part: np.ndarray, given: dict, id_type: pa.DataType) -> pa.RecordBatch:
    types = {c: pa.binary() for c in PACKED} | {"id": id_type, "u": pa.int64(), "n_shingles": pa.int64(), "set": pa.int64()}
    return pa.record_batch({"cell": cell, "part": part} | {
        c: given[c] if c in given else pa.nulls(len(cell), kind) for c, kind in types.items()})


def in_company(rows: list, known: tuple | None, more: bool) -> tuple[tuple, tuple | None]:
    """Of the rows (key, sig, mark, need) of a cell those whose bucket holds another set, and one in its own band.

    ``known`` is what comes back for the rows before, if these are not all: one
    row for every key that has a set in its own band, and whether it is out
    already.  Rows in own bands come before all others, so the rows that have
    no company yet are never more than the keys.
    """
    columns = [np.concatenate([*([known[0][i]] if known else []), *(r[i] for r in rows)]) for i in range(4)]
    out = np.zeros(len(columns[0]), bool)
    if known:
        out[:len(known[1])] = known[1]
    order = np.argsort(columns[0], kind="stable")
    key = columns[0][order]
    first = np.concatenate([[True], key[1:] != key[:-1]])
    if not more:  # a key with one row has no company
        several = ~first
        several[:-1] |= ~first[1:]
        order, first = order[several], first[several]
    columns, out = [c[order] for c in columns], out[order]
    start = np.flatnonzero(first)
    if not len(start):
        return tuple(columns), None
    size = np.diff(np.append(start, len(first)))
    _, sig, mark, _ = columns
    home = np.logical_or.reduceat(mark & HOME > 0, start)
    company = home & (np.minimum.reduceat(sig, start) != np.maximum.reduceat(sig, start)) | np.logical_or.reduceat(out, start)
    sent = np.repeat(company, size) & ~out
    kept = start[home]  # sorting is stable: a row in its own band, if the key has one
    return tuple(c[sent] for c in columns), (tuple(c[kept] for c in columns), company[home]) if more else None


def _company_rows(gather: int):
    """The keys in company, as rows, and the texts as they come, from rows in the order of cell and part."""
    texts_of = ["id", "u", "n_shingles", "set"]

    def row_batch(found: tuple, id_type: pa.DataType) -> pa.RecordBatch:
        key, sig, mark, need = found
        n = len(key)
        return pa.record_batch({"id": pa.nulls(n, id_type), "u": pa.nulls(n, pa.int64()), "n_shingles": pa.nulls(n, pa.int64()),
                                "sig": sig, "key": key.view(np.int64), "mark": mark, "need": need})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, n, known = None, [], 0, None
        for batch in batches:
            cells, parts, id_type = batch.column("cell").to_pylist(), np.asarray(batch.column("part")), batch.column("id").type
            is_text = parts == TEXT
            if is_text.any():
                own = batch.filter(pa.array(is_text))
                none = pa.nulls(len(own), pa.int32())
                yield pa.record_batch([*(own.column(c) for c in texts_of), pa.nulls(len(own), pa.int64()), none, none],
                                      names=["id", "u", "n_shingles", "sig", "key", "mark", "need"])
            columns = [(batch.column(c), kind) for c, kind in PACKED.items()]
            for i in np.flatnonzero(~is_text).tolist():
                if cells[i] != now:
                    if held:
                        yield row_batch(in_company(held, known, False)[0], id_type)
                    now, held, n, known = cells[i], [], 0, None
                held.append(tuple(np.frombuffer(c[i].as_buffer(), kind) for c, kind in columns))
                n += len(held[-1][0])
                if n >= gather:
                    found, known = in_company(held, known, True)
                    yield row_batch(found, id_type)
                    held, n = [], 0
        if held:
            yield row_batch(in_company(held, known, False)[0], id_type)
    return run


def _cells(docs: DataFrame, text_col: str, num: int, den: int) -> int:
    """Into how many cells keys are dealt: as many as hold ``CELL`` keys each, more where more tasks can run."""
    size = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    # a word takes about six bytes, a token has a share of the segments of about one and a half bands
    count = int(size / 6 * 4 * (den - num) / (den + num))
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(1, count // CELL, min(SPREAD * tasks, count // FEWEST))


def linked(token: np.ndarray, at: np.ndarray, side: np.ndarray | None, num: int, den: int) -> np.ndarray:
    """Root (an index) of every set after tying all linked ones; with ``side`` only pairs across the sides are compared."""
    n = len(at) - 1
    size = np.diff(at)
    root = np.arange(n)
    distinct, word = np.unique(token, return_inverse=True)
    often = np.bincount(word, minlength=len(distinct))
    # sets of widely shared tokens first: an original before its copies
    weight = np.add.reduceat(often[word], at[:-1]) / size if n else size
    mark = np.zeros(len(distinct), np.int64)
    for i in np.argsort(-weight, kind="stable"):
        apart = root != root[i]
        if side is not None:
            apart &= side != side[i]
        if not apart.any():
            if side is None:
                break
            continue
        mine = word[at[i]:at[i + 1]]
        mark[mine] = 1
        shared = np.add.reduceat(mark[word], at[:-1])
        mark[mine] = 0
        hit = apart & (den * shared >= num * (size + size[i] - shared))
        for r in np.unique(root[hit]):
            root[root == r] = root[i]
    return root


def _verified_rows(shingle: int, num: int, den: int):
    def solve(sigs: list, sides: list, parts: list) -> pa.RecordBatch:
        at = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
        side = np.array(sides)
        sig = np.array(sigs, np.int64)
        root = linked(np.concatenate(parts), at, side if (side != side[0]).any() else None, num, den)
        hit = root != np.arange(len(root))
        return pa.record_batch({"a": sig[hit], "b": sig[root[hit]]})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, sigs, sides, parts = None, [], [], []
        for batch in batches:
            names = list(zip(*(batch.column(c).to_pylist() for c in ("comp", "i", "j"))))
            sig, blk = batch.column("sig").to_pylist(), batch.column("blk").to_pylist()
            for lo, hi, data, offsets in texts(batch.column("text")):
                token, _, at = _sets(data, offsets, shingle)
                for x in range(lo, hi):
                    if names[x] != task:
                        if len(sigs) > 1:
                            yield solve(sigs, sides, parts)
                        task, sigs, sides, parts = names[x], [], [], []
                    sigs.append(sig[x]), sides.append(blk[x]), parts.append(token[at[x - lo]:at[x - lo + 1]])
        if len(sigs) > 1:
            yield solve(sigs, sides, parts)
    return run


def similar_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                   num: int = NUM, den: int = DEN, block: int = BLOCK) -> DataFrame:
    """One row per input row: id, ``u`` (hash of id and text), ``n_shingles``, ``group`` (hash), ``component_id``.

    Texts are linked when ``den`` * shared tokens >= ``num`` * tokens of both;
    ``component_id`` is the least id reachable by links.
    """
    spark = docs.sparkSession
    id_type = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")) \
        .withColumn("u", F.xxhash64("id", "text"))
    at = work_dir(spark, "jaccard")
    cells = _cells(docs, text_col, num, den)
    # texts are cut into words once: what is known of them and their keys leave the tasks together
    rows.mapInArrow(_index_rows(shingle, num, den, cells),
                    f"cell int, part int, key binary, sig binary, mark binary, need binary, id {id_type}, u long, n_shingles long, "
                    "set long").repartition("cell").sortWithinPartitions("cell", "part") \
        .mapInArrow(_company_rows(GATHER), f"id {id_type}, u long, n_shingles long, sig long, key long, mark int, need int") \
        .write.parquet(f"{at}/index")
    stored = spark.read.parquet(f"{at}/index")
    sets = stored.where("key is null").select("id", "u", "n_shingles", "sig")
    index = stored.where("key is not null").select("key", "sig", "mark", "need")

    bucket = Window.partitionBy("key")

    def company(df: DataFrame) -> DataFrame:
        """Rows whose bucket holds another set, and one in its own band."""
        return df.withColumn("first", F.min("sig").over(bucket)).withColumn("last", F.max("sig").over(bucket)) \
            .withColumn("homes", F.max(F.col("mark").bitwiseAND(HOME)).over(bucket)).where("first <> last and homes > 0")

    # a set has at most as many keys as its band has segments, so its list is bounded by its text
    candidates = index.groupBy("sig", F.shiftright("mark", 1).alias("place")).agg(
        F.max("need").alias("need"), F.collect_set(F.when(F.col("mark").bitwiseAND(NEAR) == 0, F.col("key"))).alias("plain"),
        F.collect_set(F.when(F.col("mark").bitwiseAND(NEAR) != 0, F.col("key"))).alias("near")) \
        .where(F.size("plain") + F.when(F.size("near") > 0, 2).otherwise(0) >= F.col("need")) \
        .select("sig", F.shiftleft("place", 1).alias("mark"), F.explode(F.concat("plain", "near")).alias("key"))
    ties = company(candidates).where("first <> sig").select(F.col("sig").alias("a"), F.col("first").alias("b"))
    groups = components(ties)
    one = sets.groupBy("sig").agg(F.min("u").alias("u"), F.first("n_shingles").alias("n")) \
        .join(groups.withColumnsRenamed({"node": "sig", "root": "comp"}), "sig")
    blocks = one.groupBy("comp").agg(F.ceil(F.sum("n") / block).cast("int").alias("blocks"))
    cut = one.join(blocks, "comp").withColumn("blk", F.pmod(F.xxhash64("sig", F.lit("block")), F.col("blocks")).cast("int"))
    # a set of block b meets every block: tasks (i, j) with i <= j and b among them
    sent = cut.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))) \
        .select("u", "sig", "comp", "blk", F.least("blk", "other").alias("i"), F.greatest("blk", "other").alias("j"))
    links = rows.select("u", "text").join(sent, "u").repartition("comp", "i", "j").sortWithinPartitions("comp", "i", "j", "sig") \
        .select("comp", "i", "j", "blk", "sig", "text") \
        .mapInArrow(_verified_rows(shingle, num, den), "a long, b long")
    final = components(links)
    group = F.when(F.col("n_shingles") > 0, F.coalesce("root", "sig"))
    named = sets.join(final, sets.sig == final.node, "left").select("id", "u", "n_shingles", group.alias("group"))
    least = named.where("group is not null").groupBy("group").agg(F.min("id").alias("least"))
    return named.join(least, "group", "left").select(
        F.col("id").alias(id_col), "u", "n_shingles", "group", F.coalesce("least", "id").alias("component_id"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
             num: int = NUM, den: int = DEN) -> DataFrame:
    """``docs``, all columns, with one row of each group (least id); texts without words all stay."""
    found = similar_groups(docs, id_col, text_col, shingle, num, den)
    best = found.where("group is not null").groupBy("group").agg(F.min(F.struct(F.col(id_col), F.col("u"))).alias("_m")) \
        .select(F.col("_m.u").alias("_u"), F.lit(True).alias("_one"))
    plain = found.where("group is null").select(F.col("u").alias("_u"), F.lit(False).alias("_one")).distinct()
    rows = docs.withColumn("_u", F.xxhash64(F.col(id_col), F.coalesce(F.col(text_col), F.lit(""))))
    kept = rows.join(best.unionByName(plain), "_u")
    # a row that is repeated as a whole is one document of its group
    nth = F.row_number().over(Window.partitionBy("_u").orderBy("_u"))
    return kept.withColumn("_n", nth).where("not _one or _n = 1").select(*docs.columns)
