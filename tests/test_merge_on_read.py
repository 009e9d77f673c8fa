"""merge_on_read snapshots equal the rewrite mode; compaction changes nothing."""

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st

from regflat.plans.snapshot import SnapshotStore
from regflat.session import work_dir
from tests.conftest import rows

S = "k string, p int"
keys_st = st.sampled_from(["a", "b", "c", None])
version_st = st.tuples(
    st.one_of(st.none(), st.lists(st.tuples(keys_st, st.integers(0, 9)), max_size=3)),
    st.one_of(st.none(), st.lists(st.tuples(keys_st, st.integers(0, 9)), max_size=3)),
    st.lists(keys_st, max_size=2))


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(versions=st.lists(version_st, min_size=1, max_size=4))
def test_merge_on_read_equals_rewrite(spark, versions):
    a = SnapshotStore(spark, work_dir(spark, "rw"), "xx")
    b = SnapshotStore(spark, work_dir(spark, "mor"), "xx", mode="merge_on_read", keys=["k"], compact_every=3)
    for i, (t1, t2, dels) in enumerate(versions, start=1):
        tables = {name: spark.createDataFrame(data, S) for name, data in (("t1", t1), ("t2", t2))
                  if data is not None}
        d = spark.createDataFrame([(k,) for k in dels], "k string")
        a.apply_version(f"v{i}", i, tables, ["k"], d)
        b.apply_version(f"v{i}", i, tables, ["k"], d)
    for name in ("t1", "t2"):
        ca, cb = a.current(name), b.current(name)
        assert (ca is None) == (cb is None)
        if ca is not None:
            assert rows(ca) == rows(cb)


def test_compaction_and_failure(spark):
    b = SnapshotStore(spark, work_dir(spark, "mor"), "xx", mode="merge_on_read", keys=["k"], compact_every=100)
    b.apply_version("v1", 1, {"t": spark.createDataFrame([("a", 1), ("b", 1)], S)}, ["k"])
    b.apply_version("v2", 2, {"t": spark.createDataFrame([("a", 2)], S)}, ["k"],
                    spark.createDataFrame([("b",)], "k string"))
    before = rows(b.current("t"))
    assert before == [("a", 2)]
    b.compact("t")
    assert rows(b.current("t")) == before
    assert b._layers("t")[1] == []
    with pytest.raises(RuntimeError):
        b.apply_version("v3", 3, {"t": spark.createDataFrame([("c", 3)], S)}, ["k"], fail_before_commit=True)
    assert rows(b.current("t")) == before and b.latest_rank() == 2


def test_no_broadcast_is_forced_on_delta_keys(spark):
    from regflat.plans.publish import session_conf
    b = SnapshotStore(spark, work_dir(spark, "mor-bc"), "xx", mode="merge_on_read", keys=["k"], compact_every=100)
    b.apply_version("v1", 1, {"t": spark.createDataFrame([("a", 1), ("b", 1)], S)}, ["k"])
    b.compact("t")
    b.apply_version("v2", 2, {"t": spark.createDataFrame([("a", 2)], S)}, ["k"])
    off = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    with session_conf(spark, off):
        cur = b.current("t")
        assert rows(cur) == [("a", 2), ("b", 1)]
        plan = cur._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" not in plan and "LeftAnti" in plan


def test_repeated_ledger_rows_do_not_duplicate_data(spark):
    b = SnapshotStore(spark, work_dir(spark, "mor-dup"), "xx", mode="merge_on_read", keys=["k"], compact_every=100)
    b.apply_version("v1", 1, {"t": spark.createDataFrame([("a", 1), ("b", 1)], S)}, ["k"])
    entries = [(v, r, {t: (k, p)}) for v, r, t, k, p in
               [(row["version"], row["rank"], row["table"], row["kind"], row["snapshot"])
                for row in b.ledger().collect()]]
    b.commit_many(entries)  # the same commit appended again (a retried write)
    assert rows(b.current("t")) == [("a", 1), ("b", 1)]
