"""Keyed merges (FIXTURES B) and the single-pass merge == ordered fold."""

from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from regflat.operators.merge import (VERSION_COL, TableVersion, align_union, bulk_merge, delete_replace,
                                     fold_merge, remove_keys, replace_by_key)
from tests.conftest import rows

S = "k string, p int"


def df(spark, data, schema=S):
    return spark.createDataFrame(data, schema)


def test_replace_group(spark):
    out = replace_by_key(df(spark, [("a", 1), ("a", 2), ("b", 3)]), df(spark, [("a", 9)]), ["k"])
    assert rows(out) == [("a", 9), ("b", 3)]


def test_delete_and_resend(spark):
    old = df(spark, [("a", 1), ("b", 3)])
    dels = spark.createDataFrame([("a",)], "k string")
    assert rows(delete_replace(old, df(spark, []), dels, ["k"])) == [("b", 3)]
    assert rows(delete_replace(df(spark, [("a", 1)]), df(spark, [("a", 9)]), dels, ["k"])) == [("a", 9)]


def test_null_keys_match_each_other(spark):
    out = replace_by_key(df(spark, [(None, 1), ("a", 2)]), df(spark, [(None, 9)]), ["k"])
    assert rows(out) == sorted([("a", 2), (None, 9)], key=repr)
    assert rows(remove_keys(df(spark, [(None, 1)]), spark.createDataFrame([(None,)], "k string"), ["k"])) == []


def test_new_column_and_type_clash(spark):
    out = replace_by_key(df(spark, [("a", 1)]), spark.createDataFrame([("b", 2, "x")], "k string, p int, z string"),
                         ["k"])
    assert sorted(map(tuple, out.collect())) == [("a", 1, None), ("b", 2, "x")]
    u = align_union(df(spark, [("a", 1)]), spark.createDataFrame([("b", "q")], "k string, p string"))
    assert dict(u.dtypes)["p"] == "string"


def test_absent_table_keeps_rows(spark):
    cur = df(spark, [("a", 1)])
    out = fold_merge(cur, [TableVersion(1, None, spark.createDataFrame([("a",)], "k string"))], ["k"])
    assert rows(out) == [("a", 1)]


def python_fold(current, versions):
    """Plain-Python statement of the reference semantics."""
    state = list(current)
    for rank, rows_v, dels_v in sorted(versions):
        if rows_v is None:
            continue
        gone = set(dels_v) | {k for k, _ in rows_v}
        state = [r for r in state if r[0] not in gone] + list(rows_v)
    return sorted(state, key=repr)


keys_st = st.sampled_from(["a", "b", "c", None])
version_st = st.tuples(
    st.one_of(st.none(), st.lists(st.tuples(keys_st, st.integers(0, 9)), max_size=4)),
    st.lists(keys_st, max_size=2))


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(current=st.lists(st.tuples(keys_st, st.integers(0, 9)), max_size=4),
       versions=st.lists(version_st, min_size=1, max_size=4))
def test_bulk_equals_fold(spark, current, versions):
    vs = [(i, r, d) for i, (r, d) in enumerate(versions)]
    expected = python_fold(current, vs)
    ups = [(k, p, i) for i, r, _ in vs if r is not None for k, p in r]
    dels = [(k, i) for i, _, d in vs for k in d]
    present = [(i,) for i, r, _ in vs if r is not None]
    deltas = spark.createDataFrame(ups, f"k string, p int, {VERSION_COL} int")
    out = bulk_merge(spark.createDataFrame(current, S) if current else None, deltas,
                     spark.createDataFrame(dels, f"k string, {VERSION_COL} int"),
                     spark.createDataFrame(present, f"{VERSION_COL} int"), ["k"])
    got = sorted([(r["k"], r["p"]) for r in out.collect()], key=repr)
    if not current and not ups:
        got = []
    assert got == expected
    tv = [TableVersion(i, None if r is None else spark.createDataFrame(r, S),
                       spark.createDataFrame([(k,) for k in d], "k string")) for i, r, d in vs]
    folded = fold_merge(spark.createDataFrame(current, S), tv, ["k"], checkpoint_every=2)
    assert sorted(map(tuple, folded.collect()), key=repr) == expected


def test_bulk_plan_has_no_window_and_no_forced_broadcast(spark):
    deltas = spark.range(100).select(F.col("id").cast("string").alias("k"), F.lit(1).alias("p"),
                                     (F.col("id") % 3).cast("int").alias(VERSION_COL))
    dels = deltas.select("k", VERSION_COL)
    present = deltas.select(VERSION_COL).distinct()
    plan = bulk_merge(None, deltas, dels, present, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(current=st.lists(st.tuples(keys_st, st.integers(0, 9)), max_size=5),
       new=st.lists(st.tuples(keys_st, st.integers(0, 9)), max_size=4),
       dels=st.lists(keys_st, max_size=2))
def test_reapplying_a_version_is_idempotent(spark, current, new, dels):
    old = spark.createDataFrame(current, S)
    n = spark.createDataFrame(new, S)
    d = spark.createDataFrame([(k,) for k in dels], "k string")
    once = delete_replace(old, n, d, ["k"])
    twice = delete_replace(once, n, d, ["k"])
    assert sorted(map(tuple, once.collect()), key=repr) == sorted(map(tuple, twice.collect()), key=repr)
