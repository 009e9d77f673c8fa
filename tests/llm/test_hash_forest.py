"""The hash-prefix forest against brute force: exact scores and ranks of what it finds, and its recall."""

import math

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from regflat.llm import hash_forest as hf

SCHEMA = "vec_id long, embedding array<float>"


def usable(rows):
    by_id = {}
    for i, v in rows:
        if i is None or not v or any(x is None or not math.isfinite(x) for x in v) or not any(v):
            continue
        v = [float(np.float32(x)) + 0.0 for x in v]
        by_id[i] = min(by_id.get(i, v), v)
    sizes = [len(v) for v in by_id.values()]
    most = max(set(sizes), key=lambda n: (sizes.count(n), -n)) if sizes else 0
    return {i: v for i, v in by_id.items() if len(v) == most}


def brute(rows, every, k):
    v = usable(rows)
    ids = np.array(sorted(v))
    m = np.array([v[i] for i in ids])
    out = {}
    for i in ids[ids % every == 0]:
        s = m @ np.array(v[int(i)])
        best = sorted((-round(float(x), 9), int(j)) for x, j in zip(s, ids) if j != i)[:k]
        out[int(i)] = best
    return out


def found(df):
    got = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        got.setdefault(r.query_id, []).append((-round(r.score, 9), r.vec_id))
        assert r.rank == len(got[r.query_id])
    return got


def recall(got, want):
    pairs = [(len({j for _, j in got.get(q, [])} & {j for _, j in w}), len(w)) for q, w in want.items()]
    return sum(x for x, _ in pairs) / sum(y for _, y in pairs)


def made(seed, n=400, dims=24, spread=True):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((12, dims))
    v = centres[rng.integers(0, 12, n)] + .25 * rng.standard_normal((n, dims))
    if spread:
        v *= rng.uniform(.1, 3, (n, 1))
    v[: n // 3] = v[0]  # a third of all rows are one vector
    return [(int(i), [float(x) for x in row]) for i, row in zip(rng.permutation(n), v)]


ODD = [(1001, None), (1002, []), (1003, [0.0] * 24), (1004, [1.0, None] * 12), (1005, [float("nan")] * 24),
       (1006, [float("inf")] + [0.0] * 23), (None, [1.0] * 24), (1020, [1.0, 2.0]), (1040, [-0.0] * 23 + [1.0])]


@pytest.mark.parametrize("near,piece,queries", [(512, 1 << 24, 2048), (3, 96 * 20, 2), (1, 96, 7)])
def test_forest_equals_brute_force_at_the_root(spark, near, piece, queries):
    """Few rows: with no miss allowed every query ascends to the root of one tree, which is exact."""
    rows = made(near) + ODD
    rows += [rows[5], (rows[7][0], [9.0] * 24)]  # a repeated row, an id with two vectors
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    for c in ("id", "v", "cid", "q", "place", "rank", "score"):
        df = df.withColumn(c, F.lit("clash"))
    out = hf.search(df, F.col("id") % 5 == 0, k=6, near=near, piece=piece, queries=queries, miss=-1.0)
    assert found(out) == brute(rows, 5, 6)


def test_recall_and_order(spark):
    rows = made(9, 3000, 32, spread=False)
    out = found(hf.search(spark.createDataFrame(rows, SCHEMA), F.col("id") % 20 == 0, near=16, piece=32 * 4 * 300))
    want = brute(rows, 20, 20)
    assert out.keys() == want.keys() and recall(out, want) >= .9
    assert all(len(x) == 20 and x == sorted(x) for x in out.values())


def test_recall_on_the_given_vectors(spark, sf):
    rows = [tuple(r.values()) for r in pq.read_table(f"{sf}/embeddings.parquet", columns=["vec_id", "embedding"]).to_pylist()]
    out = found(hf.search(spark.read.parquet(f"{sf}/embeddings.parquet"), F.col("id") % 20 == 0))
    want = brute(rows, 20, 20)
    assert out.keys() == want.keys() and recall(out, want) >= .9


def test_few_and_none(spark):
    assert hf.search(spark.createDataFrame([], SCHEMA), F.col("id") % 20 == 0).collect() == []
    one = spark.createDataFrame([(0, [1.0, 2.0])], SCHEMA)
    assert hf.search(one, F.col("id") % 20 == 0).collect() == []
    rows = [(0, [1.0]), (1, [2.0]), (2, [-1.0]), (20, [1.0])]
    out = found(hf.search(spark.createDataFrame(rows, SCHEMA), F.col("id") % 20 == 0))
    assert out == brute(rows, 20, 20) == {0: [(-2.0, 1), (-1.0, 20), (1.0, 2)], 20: [(-2.0, 1), (-1.0, 0), (1.0, 2)]}


def test_bounds_hold():
    """8-bit scores differ from the true ones by no more than the stored error."""
    rng = np.random.default_rng(1)
    p = hf.collisions(33)
    assert p[0] < .05 and p[-1] == 1.0 and (np.diff(p) >= 0).all()
    levels = hf.ascents(33)
    assert levels == sorted(levels)
    turn = hf.rotations(33)
    x = rng.standard_normal((50, 33)).astype(np.float32)
    codes = hf.strings(x, turn)
    assert codes.shape == (hf.TREES, 50) and codes.min() >= 0 and codes.max() < 1 << hf.TOTAL
    assert (hf.strings(x * 3, turn) == codes).all()
