"""Landed versions applied by the stream in rank order, gaps wait."""

import pytest

from regflat.plans.offices import GB, em_spec
from regflat.plans.snapshot import SnapshotStore
from regflat.session import work_dir
from regflat.sources.landing import table_folder
from regflat.streaming.landed_versions import MARKER_SCHEMA, contiguous_after, mark_landed, markers_of, start
from tests.conftest import rows


def _land(spark, landing, version, rank, data):
    spark.createDataFrame(data, "ApplicationNumber string, x int").write.parquet(
        table_folder(landing, "gb", version, "Application"))
    mark_landed(spark, landing, "gb", version, rank)


def test_stream_applies_contiguous_versions(spark):
    landing, ckpt = work_dir(spark, "sland"), work_dir(spark, "sckpt")
    store = SnapshotStore(spark, work_dir(spark, "ssnap"), "gb")
    _land(spark, landing, "v1", 1, [("a", 1), ("b", 1)])
    _land(spark, landing, "v3", 3, [("b", 3)])
    start(spark, GB, landing, store, ckpt).awaitTermination()
    assert store.latest_rank() == 1  # v3 waits for v2
    _land(spark, landing, "v2", 2, [("a", 2)])
    start(spark, GB, landing, store, ckpt).awaitTermination()
    assert store.latest_rank() == 3
    assert rows(store.current("Application")) == [("a", 2), ("b", 3)]


def test_schemas_of_one_office_are_streams_of_their_own(spark):
    landing, root = work_dir(spark, "sland"), work_dir(spark, "ssnap")
    stores = {}
    for schema, key in (("TradeMark", "ApplicationNumber"), ("Applicant", "ApplicantIdentifier")):
        for version, rank in (("v2", 2), ("v1", 1)):
            spark.createDataFrame([(schema[-1], rank)], f"{key} string, x int").write.parquet(
                table_folder(landing, "em", version, schema, schema))
            mark_landed(spark, landing, "em", version, rank, schema)
        stores[schema] = SnapshotStore(spark, root, "em", schema, keys=(key,))
    for schema, store in stores.items():
        start(spark, em_spec(schema), landing, store, f"{root}/_stream/{schema}").awaitTermination()
        assert store.latest_rank() == 2 and store.current(schema).collect()[0].x == 2
    with pytest.raises(ValueError):
        start(spark, em_spec("Applicant"), landing, stores["TradeMark"], f"{root}/_stream/x")


def test_only_versions_not_applied_reach_the_driver(spark):
    marks = spark.createDataFrame([("v1", 1), ("v1b", 1), ("v2", 2), ("v2", 2), ("v4", 4)], "version string, rank int")
    assert contiguous_after(marks, 1) == [("v2", 2)]
    with pytest.raises(ValueError):
        contiguous_after(marks, None)


def test_markers_without_a_schema_are_of_the_default_one(spark):
    marks = spark.createDataFrame([("gb", None, "v1", 1), ("gb", "x", "v1", 1)], MARKER_SCHEMA)
    assert markers_of(marks, "gb").count() == 1
