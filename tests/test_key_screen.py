"""The anti-join behind a filter gives the plain anti-join's rows, and moves only possible hits."""

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from regflat.operators import key_screen
from regflat.operators.key_screen import remove_keys_screened, screened
from regflat.operators.merge import remove_keys
from regflat.plans.publish import session_conf
from regflat.plans.snapshot import SnapshotStore
from regflat.session import work_dir
from tests.conftest import rows

KEYS = st.tuples(st.sampled_from(["a", "b", "", None]), st.sampled_from([0, 1, None]))


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(current=st.lists(KEYS, max_size=12), gone=st.lists(KEYS, max_size=4), tight=st.booleans())
def test_equals_the_plain_anti_join(spark, current, gone, tight):
    df = spark.createDataFrame([(*x, i) for i, x in enumerate(current)], "k string, `j-k` int, p int")
    keys = spark.createDataFrame(gone, "k string, `j-k` int")
    before = key_screen.MAX_BLOCKS
    key_screen.MAX_BLOCKS = 1 if tight else before
    try:
        got = rows(remove_keys_screened(df, keys, ["k", "j-k"]))
    finally:
        key_screen.MAX_BLOCKS = before
    assert got == rows(remove_keys(df, keys, ["k", "j-k"]))


def test_rows_without_a_key_are_not_exchanged(spark):
    df = spark.range(60000).select(F.when(F.col("id") % 3 > 0, F.col("id")).alias("k"), F.col("id").alias("p"))
    keys = spark.range(1, 3000, 3).select(F.col("id").alias("k"))
    possible, clear = screened(df, keys, ["k"], 1000)
    assert possible.count() + clear.count() == 60000 and 1000 <= possible.count() < 2500
    with session_conf(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}):
        out = remove_keys_screened(df, keys, ["k"])
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert out.count() == 59000
    union = plan.index("Union")
    lines = plan[union:].split("\n")
    column = min(x.index("+- ") for x in lines if "+- " in x)
    clear_side = lines[next(i for i, x in enumerate(lines) if x[column:].startswith("+- ")):]
    # no exchange of the rows that the filter stops: only the filter itself moves
    first_join = next(i for i, x in enumerate(clear_side) if "BroadcastHashJoin" in x)
    assert not any("Exchange" in x for x in clear_side[:first_join])
    assert any("SortMergeJoin" in x for x in lines)


@pytest.mark.parametrize("kind,value", [("double", 0.0), ("string", "1")])
def test_types_without_equal_hashes_take_the_plain_join(spark, kind, value):
    df = spark.createDataFrame([(value, 1)], f"k {kind}, p int")
    keys = spark.createDataFrame([(-0.0,)], "k double") if kind == "double" else spark.createDataFrame([(1,)], "k int")
    assert remove_keys_screened(df, keys, ["k"]).count() == 0
    assert remove_keys_screened(df, None, ["k"]).count() == 1


def test_store_with_screen(spark):
    def frame(data):
        return spark.createDataFrame(data, "k string, p int")

    told = []
    for screen in (False, True):
        store = SnapshotStore(spark, work_dir(spark, "screen"), "us", screen=screen)
        store.apply_version("v1", 1, {"main": frame([("a", 1), (None, 2), ("c", 3)])}, ["k"])
        store.apply_version("v2", 2, {"main": frame([("a", 5)])}, ["k"], deletes=spark.createDataFrame([(None,)], "k string"))
        told.append(rows(store.current("main")))
    assert told[0] == told[1] == [("a", 5), ("c", 3)]
