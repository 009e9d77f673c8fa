"""Property: landed versions applied by the ordered fold, the single pass and
the merge-on-read store all equal a plain-Python model of the published
semantics (tables absent from a version are untouched, deletes hit old rows
only, a key's rows are replaced as a group)."""

from hypothesis import HealthCheck, given, settings, strategies as st

from regflat.plans.offices import GB
from regflat.plans.snapshot import SnapshotStore
from regflat.plans.updates import apply_in_one_pass, apply_in_order
from regflat.session import work_dir
from regflat.sources.landing import mark_complete, table_folder

TABLES = ("Application", "Line")
keys_st = st.sampled_from(["a", "b", "c"])
rows_st = st.lists(st.tuples(keys_st, st.integers(0, 5)), max_size=3)
version_st = st.fixed_dictionaries({
    "Application": st.one_of(st.none(), rows_st),
    "Line": st.one_of(st.none(), rows_st),
    "delete": st.one_of(st.none(), st.lists(keys_st, max_size=2)),
})


def model(versions, cascade=False):
    state = {t: [] for t in TABLES}
    for v in versions:
        dels = set(v["delete"] or [])
        sent = {k for t in TABLES if v[t] is not None for k, _ in v[t]}
        for t in TABLES:
            if v[t] is None:
                if cascade:  # the version's keys and deletes reach tables it lacks
                    state[t] = [r for r in state[t] if r[0] not in dels | sent]
                continue
            gone = dels | {k for k, _ in v[t]}
            state[t] = [r for r in state[t] if r[0] not in gone] + list(v[t])
    return {t: sorted(rs) for t, rs in state.items()}


def land(spark, landing, versions):
    order = []
    for i, v in enumerate(versions, start=1):
        name = f"v{i:02d}"
        for t in TABLES:
            if v[t] is not None:
                spark.createDataFrame(v[t], "ApplicationNumber string, x int").write.parquet(
                    table_folder(landing, "gb", name, t))
        if v["delete"] is not None:
            spark.createDataFrame([(k,) for k in v["delete"]], "ApplicationNumber string").write.parquet(
                table_folder(landing, "gb", name, "delete"))
        mark_complete(spark, landing, "gb", name, tables=[k for k in (*TABLES, "delete") if v[k] is not None])
        order.append((name, i))
    return order


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(versions=st.lists(version_st, min_size=1, max_size=4), cascade=st.booleans())
def test_all_update_paths_equal_the_model(spark, versions, cascade):
    landing = work_dir(spark, "prop-landing")
    order = land(spark, landing, versions)
    stores = {
        "fold": SnapshotStore(spark, work_dir(spark, "prop-fold"), "gb"),
        "single": SnapshotStore(spark, work_dir(spark, "prop-single"), "gb"),
        "mor": SnapshotStore(spark, work_dir(spark, "prop-mor"), "gb", mode="merge_on_read",
                             keys=GB.keys, compact_every=2),
    }
    apply_in_order(stores["fold"], GB, landing, order, cascade=cascade)
    apply_in_one_pass(stores["single"], GB, landing, order, cascade=cascade)
    apply_in_order(stores["mor"], GB, landing, order, cascade=cascade)
    expected = model(versions, cascade)
    for name, store in stores.items():
        for t in TABLES:
            cur = store.current(t)
            got = [] if cur is None else sorted((r[0], r[1]) for r in cur.select("ApplicationNumber", "x").collect())
            assert got == expected[t], (name, t, cascade)
