"""Landing, ordered vs single-pass updates through snapshots, recovery, publish."""

import os

import pytest
from pyspark.sql import functions as F

from regflat.plans.ledger import latest, next_version, pending
from regflat.plans.offices import GB
from regflat.plans.publish import compact_table
from regflat.plans.snapshot import SnapshotStore
from regflat.plans.updates import LateVersion, apply_in_one_pass, apply_in_order, landed_families, publish_if_updated
from regflat.session import work_dir
from regflat.sources.landing import mark_complete, table_folder
from tests.conftest import rows


def land(spark, landing, office, version, tables):
    for name, data in tables.items():
        spark.createDataFrame(data[1], data[0]).write.parquet(table_folder(landing, office, version, name))
    mark_complete(spark, landing, office, version, tables=list(tables))


def _versions(spark, landing):
    # v1: full, v2: replaces a, deletes b; Line absent; v3: table Application absent but deletes c
    land(spark, landing, "gb", "v1", {"Application": ("ApplicationNumber string, x int", [("a", 1), ("b", 2), ("c", 3)]),
                                      "Line": ("ApplicationNumber string, n int", [("a", 1), ("b", 1), ("c", 1)])})
    land(spark, landing, "gb", "v2", {"Application": ("ApplicationNumber string, x int", [("a", 10)]),
                                      "delete": ("ApplicationNumber string", [("b",)])})
    land(spark, landing, "gb", "v3", {"Line": ("ApplicationNumber string, n int", [("a", 7)]),
                                      "delete": ("ApplicationNumber string", [("c",)])})
    return [("v1", 1), ("v2", 2), ("v3", 3)]


def test_landing_listing(spark):
    landing = work_dir(spark, "land")
    _versions(spark, landing)
    fam = landed_families(spark, landing, "gb")
    assert set(fam) == {"v1", "v2", "v3"} and set(fam["v2"]) == {"Application", "delete"}


def test_fold_and_single_pass_agree(spark):
    landing = work_dir(spark, "land")
    order = _versions(spark, landing)
    a = SnapshotStore(spark, work_dir(spark, "snapA"), "gb")
    b = SnapshotStore(spark, work_dir(spark, "snapB"), "gb")
    assert apply_in_order(a, GB, landing, order)
    assert apply_in_one_pass(b, GB, landing, order)
    for t in ("Application", "Line"):
        assert rows(a.current(t)) == rows(b.current(t))
    # v3's delete of c does not reach Application (absent from v3)
    assert rows(a.current("Application")) == [("a", 10), ("c", 3)]
    assert rows(a.current("Line")) == [("a", 7), ("b", 1)]  # v2 (no Line) deleted b: not reached
    assert a.latest_rank() == b.latest_rank() == 3
    # re-applying is a no-op: the ledger guards
    assert not apply_in_order(a, GB, landing, order)


def test_cascade_fold_and_single_pass_agree(spark):
    landing = work_dir(spark, "land")
    order = _versions(spark, landing)
    a = SnapshotStore(spark, work_dir(spark, "snapA"), "gb")
    b = SnapshotStore(spark, work_dir(spark, "snapB"), "gb")
    c = SnapshotStore(spark, work_dir(spark, "snapC"), "gb", mode="merge_on_read", keys=GB.keys)
    assert apply_in_order(a, GB, landing, order, cascade=True)
    assert apply_in_one_pass(b, GB, landing, order, cascade=True)
    assert apply_in_order(c, GB, landing, order, cascade=True)
    for t in ("Application", "Line"):
        assert rows(a.current(t)) == rows(b.current(t)) == rows(c.current(t))
    # v2 (no Line) re-sends a and deletes b: both reach Line; v3 (no Application) re-sends a
    # and deletes c: both reach Application, so the record a keeps only its new Line row
    assert rows(a.current("Application")) == []
    assert rows(a.current("Line")) == [("a", 7)]


def test_failure_keeps_previous_snapshot(spark):
    store = SnapshotStore(spark, work_dir(spark, "snap"), "xx")
    t1 = spark.createDataFrame([("a", 1)], "k string, p int")
    store.apply_version("v1", 1, {"t": t1}, ["k"])
    with pytest.raises(RuntimeError):
        store.apply_version("v2", 2, {"t": spark.createDataFrame([("a", 2)], "k string, p int")}, ["k"],
                            fail_before_commit=True)
    assert rows(store.current("t")) == [("a", 1)] and store.latest_rank() == 1
    store.apply_version("v2", 2, {"t": spark.createDataFrame([("a", 3)], "k string, p int")}, ["k"])
    assert rows(store.current("t")) == [("a", 3)]


def test_ledger_latest_pending_next(spark):
    led = spark.createDataFrame([("us", "d", "a", 1), ("us", "d", "b", 2), ("ca", "d", "x", 5)],
                                "office string, schema string, version string, rank int")
    assert rows(latest(led)) == [("ca", "d", "x", 5), ("us", "d", "b", 2)]
    vers = spark.createDataFrame([("us", "d", "c", 3), ("us", "d", "e", 4), ("us", "d", "a", 1),
                                  ("em", "d", "z", 1)], "office string, schema string, version string, rank int")
    assert rows(pending(vers, led), "office", "version") == [("em", "z"), ("us", "c"), ("us", "e")]
    assert rows(next_version(vers, led), "office", "version") == [("em", "z"), ("us", "c")]


def test_compact_publish(spark):
    path = work_dir(spark, "pub")
    compact_table(spark.range(1000).withColumn("ts", F.current_timestamp()), path, int96=True)
    files = [f for f in os.listdir(path.removeprefix("file:")) if f.endswith(".parquet")]
    assert len(files) == 1
    assert spark.read.parquet(path).count() == 1000
    # large target split: a tiny target gives several files
    path2 = work_dir(spark, "pub2")
    compact_table(spark.range(200000).repartition(8), path2, target_bytes=64 * 1024)
    files2 = [f for f in os.listdir(path2.removeprefix("file:")) if f.endswith(".parquet")]
    assert len(files2) > 1


def test_publish_only_if_updated(spark):
    store = SnapshotStore(spark, work_dir(spark, "snap"), "xx")
    assert publish_if_updated(store, False, work_dir(spark, "up")) == {}
    store.apply_version("v1", 1, {"t": spark.createDataFrame([("a", 1)], "k string, p int")}, ["k"])
    out = publish_if_updated(store, True, work_dir(spark, "up"))
    assert set(out) == {"t"}


def test_compact_files_without_shuffle(spark):
    from regflat.plans.publish import compact_files
    src, dst = work_dir(spark, "cf-src"), work_dir(spark, "cf-dst")
    spark.range(50000).repartition(8).write.parquet(src)
    compact_files(spark, src, dst)
    files = [f for f in os.listdir(dst.removeprefix("file:")) if f.endswith(".parquet")]
    assert len(files) == 1 and spark.read.parquet(dst).count() == 50000


def test_no_broadcast_is_forced_in_a_merge(spark):
    from regflat.operators.merge import update_table
    from regflat.plans.publish import session_conf
    landing = work_dir(spark, "land")
    order = _versions(spark, landing)
    store = SnapshotStore(spark, work_dir(spark, "snapBC"), "gb")
    off = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    with session_conf(spark, off):
        apply_in_order(store, GB, landing, order[:1])
        new = spark.read.parquet(table_folder(landing, "gb", "v2", "Application"))
        merged = update_table(store.current("Application"), new, GB.keys)
        plan = merged._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan and "LeftAnti" in plan


def test_late_version_raises_and_shifted_ranks_do_not_matter(spark):
    landing = work_dir(spark, "land")
    _versions(spark, landing)
    store = SnapshotStore(spark, work_dir(spark, "snapL"), "gb")
    assert apply_in_order(store, GB, landing, [("v1", 1), ("v3", 2)])
    # v2 arrives: its rank is now v3's old one, and v3's rank has moved
    with pytest.raises(LateVersion):
        apply_in_order(store, GB, landing, [("v1", 1), ("v2", 2), ("v3", 3)])
    with pytest.raises(LateVersion):
        apply_in_one_pass(store, GB, landing, [("v1", 1), ("v2", 2), ("v3", 3)])
    # a listing that lost its oldest folder goes on after the ledger
    land(spark, landing, "gb", "v4", {"Line": ("ApplicationNumber string, n int", [("d", 9)])})
    assert apply_in_order(store, GB, landing, [("v3", 1), ("v4", 2)])
    assert store.committed_versions() == {"v1": 1, "v3": 2, "v4": 3}
    with pytest.raises(ValueError):
        store.apply_version("v4", 9, {}, GB.keys)


def test_unmarked_landing_is_not_landed(spark):
    landing = work_dir(spark, "land")
    spark.createDataFrame([("a", 1)], "ApplicationNumber string, x int").write.parquet(
        table_folder(landing, "gb", "v1", "Application"))
    assert landed_families(spark, landing, "gb") == {}
    mark_complete(spark, landing, "gb", "v1")
    assert set(landed_families(spark, landing, "gb")["v1"]) == {"Application"}


def test_expired_snapshots_go_and_readers_keep_theirs(spark):
    landing = work_dir(spark, "land")
    order = _versions(spark, landing)
    for mode in ("rewrite", "merge_on_read"):
        store = SnapshotStore(spark, work_dir(spark, f"snapE-{mode}"), "gb", mode=mode, keys=GB.keys, compact_every=2)
        apply_in_order(store, GB, landing, order)
        before = {t: rows(store.current(t)) for t in store.tables()}
        gone = store.expire(1)
        assert {t: rows(store.current(t)) for t in store.tables()} == before
        assert all(not os.path.exists(p.removeprefix("file:")) for p in gone)
        if mode == "rewrite":
            assert gone and store.expire(1) == gone  # nothing else goes later


def test_failed_publish_leaves_the_live_table(spark):
    from regflat.plans.publish import compact_files
    src, dst = work_dir(spark, "pub-src"), work_dir(spark, "pub-live") + "/t.parquet"
    spark.range(10).write.parquet(src)
    compact_files(spark, src, dst)
    with pytest.raises(Exception):
        compact_files(spark, src + "-missing", dst)
    assert spark.read.parquet(dst).count() == 10
    spark.range(20).write.mode("overwrite").parquet(src)
    compact_files(spark, src, dst)
    assert spark.read.parquet(dst).count() == 20
    assert [f for f in os.listdir(os.path.dirname(dst).removeprefix("file:")) if "._" in f] == []
