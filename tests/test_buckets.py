"""Merges of bucketed current tables: equal to the ordered fold, and no exchange of the current table."""

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from regflat.operators.merge import TableVersion, fold_merge
from regflat.plans import buckets
from regflat.plans.publish import session_conf
from regflat.session import work_dir
from tests.conftest import rows

S = "k string, j int, p int"
SORT_MERGE = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
KEYS = st.sampled_from(["a", "b", "", "1:a", "-", None])
ROWS = st.lists(st.tuples(KEYS, st.sampled_from([0, 1, None]), st.integers(0, 3)), max_size=8)
DELETES = st.none() | st.lists(st.tuples(KEYS, st.sampled_from([0, 1, None])), max_size=3)


@settings(max_examples=3, deadline=None, suppress_health_check=list(HealthCheck))
@given(current=ROWS, versions=st.lists(st.tuples(ROWS, DELETES), min_size=1, max_size=2))
def test_equals_the_fold(spark, current, versions):
    def frames(rows_, deletes):
        return spark.createDataFrame(rows_, S), None if deletes is None else spark.createDataFrame(deletes, "k string, j int")

    base = spark.createDataFrame(current, S)
    at = work_dir(spark, "bucketed")
    table = buckets.write_bucketed(base, f"{at}/0", ["k", "j"], 3)
    for i, v in enumerate(versions):
        table = buckets.merge_bucketed(table, f"{at}/{i + 1}", *frames(*v))
    told = fold_merge(base, [TableVersion(i, *frames(*v)) for i, v in enumerate(versions)], ["k", "j"])
    assert rows(table.rows(), "k", "j", "p") == rows(told, "k", "j", "p")


def test_current_table_is_not_exchanged(spark):
    base = spark.range(5000).select((F.col("id") % 700).alias("k"), F.col("id").alias("p"))
    at = work_dir(spark, "bucketed")
    table = buckets.write_bucketed(base, f"{at}/0", ["k"], 7)
    delta = spark.range(0, 900, 3).select(F.col("id").alias("k"), F.lit(-1).cast("long").alias("p"))
    with session_conf(spark, SORT_MERGE):
        kept, _, _ = buckets.merged(table, delta)
        plan = kept._jdf.queryExecution().sparkPlan().toString()
        physical = kept._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan
        # the children of the join: current table, then the version's keys with their two exchanges
        lines = physical.split("\n")
        at_join = next(i for i, x in enumerate(lines) if "SortMergeJoin" in x)
        column = lines[at_join + 1].index(":- ")
        second = next(i for i in range(at_join + 1, len(lines)) if lines[i][column:].startswith("+- "))
        current, version = "\n".join(lines[at_join + 1:second]), "\n".join(lines[second:])
        assert "Bucketed: true" in current and "Exchange" not in current
        assert "Exchange hashpartitioning(_regflat_key" in version
        after = buckets.merge_bucketed(table, f"{at}/1", delta)
    assert after.buckets == 7
    assert rows(after.rows()) == sorted(
        [(k, p) for k, p in ((x % 700, x) for x in range(5000)) if k % 3] + [(x, -1) for x in range(0, 900, 3)], key=repr)


def test_new_columns_and_names_with_hyphens(spark):
    at = work_dir(spark, "bucketed")
    base = spark.createDataFrame([("a", 1), ("b", 2)], "`serial-number` string, `filing date` int")
    table = buckets.write_bucketed(base, f"{at}/0", ["serial-number"], 2)
    out = buckets.merge_bucketed(table, f"{at}/1", spark.createDataFrame(
        [("b", "x", [1])], "`serial-number` string, `filing date` string, z array<int>")).rows()
    assert rows(out, "serial-number", "filing date", "z") == [("a", "1", None), ("b", "x", [1])]


def test_hot_keys_leave_the_buckets(spark, monkeypatch):
    monkeypatch.setattr(buckets, "MIN_HOT", 50)
    at = work_dir(spark, "bucketed")
    base = spark.range(900).select(F.when(F.col("id") % 3 > 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"),
                                   F.col("id").alias("p"))
    table = buckets.write_bucketed(base, f"{at}/0", ["k"], 4)
    assert table.hot().select("k").distinct().collect()[0].k == "hot" and table.hot().count() == 600
    assert rows(table.rows()) == rows(base)
    out = buckets.merge_bucketed(table, f"{at}/1", spark.createDataFrame([("hot", 5)], "k string, p long"),
                                 spark.createDataFrame([("3",)], "k string"))
    assert out.hot().count() == 0 and out.rows().where("k = 'hot'").count() == 1 and out.rows().count() == 300


def test_leaves_no_names_behind_and_refuses_inexact_keys(spark):
    at = work_dir(spark, "bucketed")
    table = buckets.write_bucketed(spark.createDataFrame([], "k string, p int"), f"{at}/0", ["k"], 2)
    assert table.rows().count() == 0
    assert not [x for x in spark.catalog.listTables() if x.name.startswith("regflat_")]
    with pytest.raises(TypeError):
        buckets.write_bucketed(spark.createDataFrame([(1.0,)], "k double"), f"{at}/1", ["k"], 2)
