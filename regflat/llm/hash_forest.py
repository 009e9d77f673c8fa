"""Approximate nearest neighbours by inner product: a hash-prefix forest of sorted arrays.

Method.  Vectors are scaled by the largest norm and get one more coordinate, so that inner products become cosines.  In
each of ``TREES`` trees a vector has a string of ``SYMBOLS`` symbols; a symbol names the coordinate, with sign, that is
largest after a random rotation (to ``WIDE`` dimensions), and near vectors share symbols often.  A tree is the array of
all strings in order.  Descending, a query meets its longest-prefix matches: they stand next to its own string.  They
give a lower bound s of its k-th similarity.  Then all trees ascend together to the longest prefix length x at which a
neighbour as near as s is missed with a probability of ``MISS`` at most, (1 - p(s)^x)^TREES, p being the chance to share
a symbol (simulated once per dimension, as ``collisions`` does); every string with that prefix is a candidate, however
many there are.  Where even one symbol is too much to ask, the query ascends to the root of one tree: all rows, exact.
Recall is at least 1 - ``MISS`` for the k-th neighbour and higher for nearer ones.

Candidates are ranked on 8-bit vectors whose error is bounded row by row, so nothing that may belong to the best is
dropped; the rest is scored on the original vectors in double precision.

Scale.  Equal vectors are one entry; of each group the k + 1 least ids are kept, more can never be among the k nearest, so
a vector that a third of all rows hold is no hot entry.  Strings are range-partitioned and cut into pieces of at most
``PIECE`` bytes of vectors, Arrow files below the shared folder; queries travel to the pieces that their prefix covers,
many of them for one piece in several tasks (``QUERIES`` each).

Defined results: rows with a null id, a null or empty or zero vector, or one with null or non-finite components take no
part; neither do vectors of another length than most rows have (ties: the shorter).  Of rows with one id the least vector
counts.  A query's own id is never found.  Fewer candidates than k are all returned; an empty table gives no rows.
Other columns take no part, whatever their names.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as fs
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import work_dir

K = 20
TREES = 20
SYMBOLS = 8
WIDE = 32
BITS = 6  # of a symbol: WIDE coordinates with a sign
TOTAL = SYMBOLS * BITS
MISS = 0.1
NEAR = 512  # strings on either side that the descent looks at
PIECE = 16 << 20
QUERIES = 2048
SCORES = 1 << 22  # scores held at once


def rotations(dims: int, seed: int = 12) -> np.ndarray:
    """(trees * symbols, dims, width): random orthonormal columns."""
    rng = np.random.default_rng(seed)
    width = min(WIDE, dims)
    return np.stack([np.linalg.qr(rng.standard_normal((dims, width)))[0] for _ in range(TREES * SYMBOLS)]).astype(np.float32)


def strings(x: np.ndarray, turn: np.ndarray) -> np.ndarray:
    """(trees, rows): the strings of unit vectors as 48-bit numbers, first symbol highest."""
    out = np.zeros((TREES, len(x)), np.int64)
    rows = np.arange(len(x))
    for k, r in enumerate(turn):
        p = x @ r
        at = np.abs(p).argmax(1)
        t = k // SYMBOLS
        out[t] = out[t] << BITS | (at * 2 + (p[rows, at] > 0))
    return out


def collisions(dims: int, steps: int = 50, pairs: int = 8000, seed: int = 13) -> np.ndarray:
    """Chance that two unit vectors share a symbol, for similarities 0, 1/steps, .. 1."""
    rng = np.random.default_rng(seed)
    width = min(WIDE, dims)
    x, z = (rng.standard_normal((pairs, dims)) for _ in range(2))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    z -= (z * x).sum(1, keepdims=True) * x
    z /= np.maximum(np.linalg.norm(z, axis=1, keepdims=True), 1e-12)
    x, z = x[:, :width], z[:, :width]
    rows = np.arange(pairs)

    def symbol(v):
        at = np.abs(v).argmax(1)
        return at * 2 + (v[rows, at] > 0)

    own = symbol(x)
    found = [(symbol(s * x + math.sqrt(1 - s * s) * z) == own).mean() for s in np.arange(steps + 1) / steps]
    return np.maximum.accumulate(np.array(found))


def ascents(dims: int, miss: float = MISS) -> list[float]:
    """For each prefix length from 1 on, the least similarity at which it misses a neighbour with ``miss`` at most."""
    p = collisions(dims)
    out = []
    for x in range(1, SYMBOLS + 1):
        good = np.flatnonzero((1 - p ** x) ** TREES <= miss)
        out.append(float(good[0] / (len(p) - 1)) if len(good) else 2.0)
    return out


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dims)


def _entries(dims: int, largest: float, turn):
    """Every vector's string in every tree with its 8-bit form: steps of ``scale``, at most ``err`` from the vector."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 2048):
                part = batch.slice(lo, 2048)
                v = _matrix(part.column("v"), dims)
                x = v / largest
                x = np.concatenate([x, np.sqrt(np.maximum(0, 1 - (x * x).sum(1, keepdims=True)))], 1).astype(np.float32)
                scale = np.abs(v).max(1) / 127
                small = np.rint(v / scale[:, None]).astype(np.int8)
                back = small * scale[:, None]
                # what scoring in single precision may add
                err = np.linalg.norm(v - back, axis=1) + dims * 2.0 ** -22 * np.linalg.norm(back, axis=1)
                body = pa.FixedSizeBinaryArray.from_buffers(pa.binary(dims), len(v), [None, pa.py_buffer(small.tobytes())])
                body = body.cast(pa.binary())
                for t, code in enumerate(strings(x, turn.value)):
                    yield pa.record_batch({
                        "tree": pa.array(np.full(len(v), t, np.int32)), "code": pa.array(code), "cid": part.column("cid"),
                        "body": body, "scale": pa.array(scale), "err": pa.array(err)})
    return run


def _codes(dims: int, turn):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = _matrix(batch.column("v"), dims)
            x = v / np.linalg.norm(v, axis=1, keepdims=True)
            x = np.concatenate([x, np.zeros((len(x), 1))], 1).astype(np.float32)
            for t, code in enumerate(strings(x, turn.value)):
                yield pa.record_batch({"q": batch.column("cid"), "tree": pa.array(np.full(len(v), t, np.int32)),
                                       "code": pa.array(code)})
    return run


def _write_pieces(folder: str, most: int):
    """Runs of at most ``most`` strings of one tree, in order, as files; returns where each begins."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where, root = fs.FileSystem.from_uri(folder)
        where.create_dir(root)
        held: list[pa.RecordBatch] = []
        size, tree = 0, None

        def written() -> pa.RecordBatch:
            # a name of its own for every attempt; the row returned says which one counts
            name = f"{uuid.uuid4().hex}.arrow"
            with where.open_output_stream(f"{root}/{name}") as out, pa.ipc.new_file(out, held[0].schema) as file:
                for b in held:
                    file.write_batch(b)
            return pa.record_batch({"tree": pa.array([tree], pa.int32()), "name": [name],
                                    "first": pa.array([held[0].column("code")[0].as_py()], pa.int64()),
                                    "last": pa.array([held[-1].column("code")[-1].as_py()], pa.int64())})

        for batch in batches:
            trees = batch.column("tree").to_numpy()
            lo = 0
            while lo < batch.num_rows:
                if size and (trees[lo] != tree or size == most):
                    yield written()
                    held, size = [], 0
                tree = int(trees[lo])
                hi = min(int(np.searchsorted(trees, tree, side="right")), lo + most - size)
                held.append(batch.slice(lo, hi - lo).drop_columns(["tree"]))
                size, lo = size + hi - lo, hi
        if size:
            yield written()
    return run


class _Piece:
    def __init__(self, where, path: str, dims: int):
        with where.open_input_file(path) as file:
            table = pa.ipc.open_file(file).read_all().combine_chunks()
        self.code = table.column("code").to_numpy()
        self.cid = table.column("cid").to_numpy()
        self.err = table.column("err").to_numpy().astype(np.float32)
        scale = table.column("scale").to_numpy().astype(np.float32)
        body = b"".join(table.column("body").to_pylist())
        self.v = np.frombuffer(body, np.int8).reshape(-1, dims).astype(np.float32) * scale[:, None]

    def best(self, q: np.ndarray, norm: np.ndarray, lo: int, hi: int, k: int) -> tuple[np.ndarray, ...]:
        """Of rows lo .. hi - 1, for each query all that may be among its k best: (query, cid, score, its error)."""
        s = q @ self.v[lo:hi].T
        eps = norm[:, None] * self.err[None, lo:hi]
        if hi - lo > k:
            least = np.partition(s - eps, hi - lo - k, axis=1)[:, hi - lo - k]
            who, at = np.nonzero(s + eps >= least[:, None])
        else:
            who, at = (x.ravel() for x in np.indices(s.shape))
        return who, self.cid[lo + at], s[who, at], eps[who, at]


_FOUND = "q long, cid long, score double, eps double"


def _look(folder: str, dims: int, k: int, near: int):
    """Candidates of each routed query in its piece: next to its string (``near``), or all from ``lo`` to ``hi``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where, root = fs.FileSystem.from_uri(folder)
        name, piece = None, None
        for batch in batches:
            names = np.array(batch.column("name").to_pylist())
            low, high, who = (batch.column(c).to_numpy() for c in ("lo", "hi", "q"))
            v = _matrix(batch.column("v"), dims)
            norms = np.linalg.norm(v, axis=1).astype(np.float32) * np.float32(1 + 1e-6)
            v = v.astype(np.float32)
            begin = 0
            while begin < len(names):
                end = begin + int(np.argmax(np.append(names[begin:] != names[begin], True)))
                if names[begin] != name:
                    name = names[begin]
                    piece = _Piece(where, f"{root}/{name}", dims)
                a = np.searchsorted(piece.code, low[begin:end], side="left")
                b = np.searchsorted(piece.code, high[begin:end], side="right")
                if near:
                    a, b = np.maximum(0, a - near), np.minimum(len(piece.code), np.minimum(b, a + near) + near)
                # queries with one range are scored together
                for x, y in sorted(set(zip(a.tolist(), b.tolist()))):
                    if x >= y:
                        continue
                    own = begin + np.flatnonzero((a == x) & (b == y))
                    step = max(1, SCORES // (y - x))
                    for lo in range(0, len(own), step):
                        rows = own[lo:lo + step]
                        i, cid, score, eps = piece.best(v[rows], norms[rows], x, y, k)
                        yield pa.record_batch({"q": pa.array(who[rows[i]]), "cid": pa.array(cid),
                                               "score": pa.array(score.astype(np.float64)), "eps": pa.array(eps.astype(np.float64))})
                begin = end
    return run


def _stored(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def usable(rows: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, v) of the rows that take part, one per id, v in double precision."""
    v = F.transform(F.col(vec_col), lambda x: x.cast("double") + F.lit(0.0))
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return rows.select(F.col(id_col).cast("long").alias("id"), v.alias("v")) \
        .where(F.col("id").isNotNull() & F.col("v").isNotNull()).where(~bad & F.exists("v", lambda x: x != 0)) \
        .groupBy("id").agg(F.min("v").alias("v"))


def _inner(a: str, b: str) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def search(rows: DataFrame, is_query: Column, k: int = K, id_col: str = "vec_id", vec_col: str = "embedding", near: int = NEAR,
           piece: int = PIECE, queries: int = QUERIES, miss: float = MISS) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k nearest of every row whose id meets ``is_query`` (a condition on ``id``)."""
    spark = rows.sparkSession
    base = work_dir(spark, "hash-forest")
    result = "query_id long, rank int, vec_id long, score double"
    valid = _stored(usable(rows, id_col, vec_col), f"{base}/valid")
    kinds = valid.groupBy(F.size("v").alias("dims")).agg(F.count(F.lit(1)).alias("n"), F.max(_inner("v", "v")).alias("norm")) \
        .orderBy(F.desc("n"), "dims").first()
    if kinds is None:
        return spark.createDataFrame([], result)
    dims, largest = kinds.dims, math.sqrt(kinds.norm)
    valid = valid.where(F.size("v") == dims)
    turn = spark.sparkContext.broadcast(rotations(dims + 1))

    # equal vectors: the k + 1 least ids, the first of them names the group
    order = Window.partitionBy("v").orderBy("id")
    grouped = valid.withColumn("place", F.row_number().over(order)) \
        .withColumn("cid", F.first("id").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))) \
        .where(F.col("place") <= k + 1)
    members = _stored(grouped, f"{base}/members")
    classes = members.where("place = 1").select("cid", "v")
    asked = _stored(valid.where(is_query).join(classes, "v").select(F.col("id").alias("query_id"), F.col("cid").alias("q")),
                    f"{base}/asked")
    asking = _stored(classes.join(asked.select(F.col("q").alias("cid")).distinct(), "cid"), f"{base}/asking")

    entries = classes.mapInArrow(_entries(dims, largest, turn), "tree int, code long, cid long, body binary, scale double, err double")
    most = max(1, piece // (4 * dims))
    pieces = entries.repartitionByRange("tree", "code", "cid").sortWithinPartitions("tree", "code", "cid") \
        .mapInArrow(_write_pieces(f"{base}/forest", most), "tree int, name string, first long, last long")
    pieces = _stored(pieces, f"{base}/pieces")
    # a piece answers for the strings up to where the next one begins
    by_tree = Window.partitionBy("tree").orderBy("first", "last", "name")
    top = (1 << TOTAL) - 1
    spans = pieces.select("tree", "name",
                          F.when(F.row_number().over(by_tree) == 1, 0).otherwise(F.col("first")).alias("a"),
                          F.coalesce(F.lead("first").over(by_tree), F.lit(top)).alias("b"))
    # pieces and prefixes meet in cells, about as many as a tree has pieces
    shift = TOTAL - max(0, math.ceil(math.log2(max(1, pieces.count() / TREES))))
    cells = lambda a, b: F.explode(F.sequence(F.shiftright(a, shift), F.shiftright(b, shift)))
    spans = _stored(spans.withColumn("cell", cells("a", "b")), f"{base}/spans")
    codes = _stored(asking.mapInArrow(_codes(dims, turn), "q long, tree int, code long"), f"{base}/codes")

    def looked(ranges: DataFrame, beside: int, name: str) -> DataFrame:
        """Candidates within ranges (q, tree, lo, hi)."""
        routed = ranges.withColumn("cell", cells("lo", "hi")).join(spans, ["tree", "cell"]) \
            .where((F.col("a") <= F.col("hi")) & (F.col("b") >= F.col("lo"))).select("q", "name", "lo", "hi").distinct()
        routed = _stored(routed, f"{base}/{name}-routed")
        load = routed.groupBy("name").agg(F.ceil(F.count(F.lit(1)) / queries).alias("parts"))
        full = routed.join(load, "name").withColumn("part", F.pmod(F.xxhash64("q"), F.col("parts"))) \
            .join(asking.withColumnRenamed("cid", "q"), "q")
        found = full.select("name", "part", "q", "lo", "hi", "v").repartition("name", "part").sortWithinPartitions("name", "lo") \
            .mapInArrow(_look(f"{base}/forest", dims, k + 1, beside), _FOUND)
        return _stored(found, f"{base}/{name}")

    def bounded(found: DataFrame) -> DataFrame:
        """With the (k + 1)-th best lower bound of the query's score, null with fewer candidates."""
        one = found.groupBy("q", "cid").agg(F.max("score").alias("score"), F.max("eps").alias("eps")) \
            .withColumn("low", F.col("score") - F.col("eps"))
        ranked = one.withColumn("place", F.row_number().over(Window.partitionBy("q").orderBy(F.desc("low")))) \
            .where(F.col("place") <= k + 1)
        least = ranked.where(F.col("place") == k + 1).select("q", F.col("low").alias("least"))
        return one.join(least, "q", "left")

    met = looked(codes.select("q", "tree", F.col("code").alias("lo"), F.col("code").alias("hi")), near, "met")
    # similarity of the k-th neighbour so far, as the trees see it
    so_far = bounded(met).groupBy("q").agg(F.max("least").alias("least"))
    norm = asking.select(F.col("cid").alias("q"), F.sqrt(_inner("v", "v")).alias("norm"))
    near_as = F.col("least") / (F.col("norm") * F.lit(largest))
    level = sum((F.when(near_as >= s, 1).otherwise(0) for s in ascents(dims + 1, miss)), F.lit(0))
    levels = so_far.join(norm, "q").select("q", F.when(F.col("least").isNull(), 0).otherwise(level).alias("x"))
    size = F.expr(f"shiftleft(1L, CAST({TOTAL} - x * {BITS} AS INT))")
    prefix = (F.col("code") - F.pmod(F.col("code"), size)).alias("lo")
    ranges = codes.join(levels, "q").where((F.col("x") > 0) | (F.col("tree") == 0)) \
        .select("q", "tree", "x", prefix, size.alias("size")).select("q", "tree", "lo", (F.col("lo") + F.col("size") - 1).alias("hi"))
    more = looked(ranges, 0, "more")
    likely = bounded(met.unionByName(more)).where(F.col("least").isNull() | (F.col("score") + F.col("eps") >= F.col("least")))

    exact = likely.select("q", "cid").join(classes, "cid").join(
        asking.select(F.col("cid").alias("q"), F.col("v").alias("w")), "q").select("q", "cid", _inner("v", "w").alias("score"))
    listed = exact.join(members.select("cid", "id"), "cid") \
        .withColumn("place", F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "id"))).where(F.col("place") <= k + 1) \
        .groupBy("q").agg(F.sort_array(F.collect_list(F.struct("place", F.col("id").alias("vec_id"), "score"))).alias("best"))
    others = F.slice(F.filter("best", lambda b: b["vec_id"] != F.col("query_id")), 1, k)
    return asked.join(listed, "q").select("query_id", F.posexplode(others).alias("rank", "b")) \
        .select("query_id", (F.col("rank") + 1).alias("rank"), "b.vec_id", "b.score")
