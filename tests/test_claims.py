"""Two writers of one store: exactly one commits a rank, and no committed folder is written again."""

import os
from concurrent.futures import ThreadPoolExecutor

import pytest

from regflat.plans import claims
from regflat.plans.snapshot import SnapshotStore
from regflat.session import work_dir
from tests.conftest import rows


def _files(store, table):
    path = store.committed()[table].removeprefix("file://").removeprefix("file:")
    return {f: os.stat(f"{path}/{f}").st_mtime_ns for f in os.listdir(path)}


def test_one_of_many_creates(spark):
    base = work_dir(spark, "claims")
    with ThreadPoolExecutor(8) as pool:
        won = list(pool.map(lambda i: claims.create_if_absent(spark, f"{base}/x", str(i)), range(40)))
    assert sum(won) == 1
    assert int(spark.read.text(f"{base}/x").first()[0]) == won.index(True)


@pytest.mark.parametrize("mode", ["rewrite", "merge_on_read"])
def test_two_writers_of_one_rank(spark, mode):
    root = work_dir(spark, "two-writers")
    stores = [SnapshotStore(spark, root, "xx", mode=mode, keys=["k"]) for _ in range(2)]
    frames = [spark.createDataFrame([(1, f"w{i}")], "k int, v string") for i in range(2)]

    def write(i):
        try:
            stores[i].apply_version("v1", 1, {"t": frames[i]}, ["k"])
            return i
        except (claims.Conflict, ValueError):
            return None

    with ThreadPoolExecutor(2) as pool:
        won = [x for x in pool.map(write, range(2)) if x is not None]
    assert len(won) == 1
    for s in stores:
        assert rows(s.current("t")) == [(1, f"w{won[0]}")] and s.committed_versions() == {"v1": 1}


def test_state_moved_on_and_failed_attempts(spark):
    root = work_dir(spark, "moved")
    a, b = (SnapshotStore(spark, root, "xx") for _ in range(2))
    frame = lambda v: spark.createDataFrame([(1, v)], "k int, v string")
    a.apply_version("v1", 1, {"t": frame("one")}, ["k"])
    before = _files(a, "t")
    # b merges into the state of rank 1 while a commits rank 2
    with pytest.raises(claims.Conflict):
        with b.claimed(3) as held:
            path = b.write_snapshot("t", 3, frame("three"))
            a.apply_version("v2", 2, {"t": frame("two")}, ["k"])
            b.commit_many([("v3", 3, {"t": path})], held, since=1)
    assert rows(a.current("t")) == [(1, "two")]
    # the failed rank was given back; its next attempt writes beside the first
    b.apply_version("v3", 3, {"t": frame("again")}, ["k"])
    assert rows(a.current("t")) == [(1, "again")] and a.committed()["t"].endswith("v=3.1")
    assert {f: os.stat(f"{root.removeprefix('file://')}/xx/default/t/v=1/{f}").st_mtime_ns for f in before} == before


def test_dead_writers(spark):
    root = work_dir(spark, "dead")
    frame = spark.createDataFrame([(1, "x")], "k int, v string")
    dead, later, patient = SnapshotStore(spark, root, "xx"), SnapshotStore(spark, root, "xx", lease=0), SnapshotStore(spark, root, "xx")
    gone = claims.claim(spark, dead._claims, 1)  # a writer that never came back
    with pytest.raises(claims.Conflict):
        patient.apply_version("v1", 1, {"t": frame}, ["k"])
    later.apply_version("v1", 1, {"t": frame}, ["k"])
    assert later.committed()["t"].endswith("v=1.1")
    with pytest.raises(claims.Conflict):  # it wakes up after it was taken over
        claims.commit(spark, gone, [("v1", 1, {})])
    # a writer that died between its commit and the ledger: the next one completes it
    with dead.claimed(2) as held:
        path = dead.write_snapshot("t", 2, spark.createDataFrame([(2, "y")], "k int, v string"))
        claims.commit(spark, held[0], [("v2", 2, {"t": path})])
    assert rows(patient.current("t")) == [(1, "x")]
    with pytest.raises(ValueError):
        patient.apply_version("v2", 2, {"t": frame}, ["k"])
    assert rows(patient.current("t")) == [(2, "y")] and patient.committed_versions() == {"v1": 1, "v2": 2}
