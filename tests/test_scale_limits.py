"""What keeps memory, tasks and bytes from growing faster than the tables."""

import glob
import os

from pyspark.sql import functions as F, types as T

from regflat.plans import buckets, feed_standins, publish, snapshot, standins, updates
from regflat.plans.offices import US
from regflat.plans.publish import session_conf
from regflat.session import work_dir
from regflat.sources import xml_lexer, xml_records
from tests.conftest import rows


def _land(spark, purpose, body):
    path = work_dir(spark, purpose)
    os.makedirs(path)
    with open(f"{path}/feed.xml", "w") as f:
        f.write(body)
    return path


def _records(n):
    return "<r>" + "".join(f"<rec><k>{i}</k><v>{'x' * 20}</v></rec>\n" for i in range(n)) + "</r>"


def test_joins_of_records_are_not_broadcast(spark):
    """Spark measures only the ranges below the records, so any table of records looks small (F1)."""
    schema = T.StructType([T.StructField("k", T.StringType()), T.StructField("v", T.StringType())])
    path = _land(spark, "join", _records(50))
    a, b = (xml_records.read_records(spark, path, "rec", schema).dropDuplicates() for _ in range(2))
    both = a.join(b, "k")
    assert both.count() == 50
    both.collect()
    plan = both._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


def test_merge_broadcasts_stay_small():
    """9 million keys were measured as 216 MB and took over 1 GB of the driver."""
    assert snapshot.MERGE_BROADCAST_BYTES <= 32 << 20


def test_short_ranges_make_no_tasks_of_their_own(spark):
    path = _land(spark, "short", _records(200))
    strings = xml_records.record_strings(spark, path, "rec", range_bytes=50)
    assert strings.rdd.getNumPartitions() == 1 and strings.count() == 200


def test_the_end_of_a_record_is_read_in_small_steps():
    body = _records(40_000).encode()

    class File:
        read = 0

        def read_at(self, n, at):
            self.read += n
            return body[at:at + n]

    file, records = File(), xml_lexer.Records("rec")
    list(records.feed(body[:body.index(b"<v>")]))
    pieces = xml_records._pieces(file, len(body), body.index(b"<v>"), len(body), xml_records.LEAST)
    found = list(records.feed(next(pieces)[1], only_open=True))
    assert len(found) == 1 and records.parts is None and records.state == xml_lexer.OUT
    assert file.read < 10 * xml_records.LEAST


def test_a_merged_snapshot_is_written_by_the_tasks_of_the_merge(spark):
    """Few write tasks would run all partitions of the join one after another."""
    store = snapshot.SnapshotStore(spark, work_dir(spark, "many-tasks"), "us", keys=("k",))
    df = spark.range(100).select(F.col("id").cast("string").alias("k"), F.lit(0).alias("v"))
    store.apply_version("a", 1, {"t": df.repartition(3)}, ["k"])
    store.apply_version("b", 2, {"t": df.where("k < 10").withColumn("v", F.lit(1))}, ["k"])
    assert rows(store.current("t")) == sorted([(str(i), int(i < 10)) for i in range(100)], key=repr)
    assert len(glob.glob(f"{store.committed()['t'].removeprefix('file://')}/*.parquet")) > 1


def test_writing_by_folder_does_not_sort(spark, monkeypatch):
    seen = {}
    plain = publish.session_conf
    monkeypatch.setattr(publish, "session_conf", lambda s, conf: seen.update(conf) or plain(s, conf))
    path = work_dir(spark, "folders")
    publish.compact_table(spark.range(20).select("id", (F.col("id") % 3).alias("p")), path, partition_by=("p",))
    assert spark.read.parquet(path).count() == 20
    assert int(seen["spark.sql.maxConcurrentOutputFileWriters"]) >= 4


def test_landed_records_are_packed_and_bounded(spark, monkeypatch):
    monkeypatch.setattr(standins, "LANDED_RECORDS", 10)
    df = spark.range(35).coalesce(1).select(F.col("id").alias("key"), F.struct(F.lit("a <tmk__b> & c").alias("tmk__T")).alias("com__S"))
    path, schema = standins._land_xml(spark, df, "rec", "packed")
    files = glob.glob(f"{path.removeprefix('file://')}/part-*")
    assert len(files) == 4 and all(f.endswith(".gz") for f in files)
    assert xml_records.read_records(spark, path, "rec", schema).select(F.col("key").cast("int")).distinct().count() == 35
    got = standins._read_landed_prefixed(spark, df, "rec", "packed-2", "").select("key", "`com:S`.`tmk:T`")
    assert rows(got) == sorted([(str(i), "a <tmk__b> & c") for i in range(35)], key=repr)


def test_the_feed_of_the_largest_table_is_packed_and_bounded(spark, monkeypatch):
    """As plain text it took 40 times the bytes of the lines that it is made of (F2)."""
    monkeypatch.setattr(standins, "LANDED_RECORDS", 10)
    sf = work_dir(spark, "lines")
    lines = [(i // 3, i % 2 + 1) for i in range(100)] + [(None, 1), (7, None)]
    spark.createDataFrame(lines, "l_orderkey bigint, l_linenumber int").coalesce(1).write.parquet(f"{sf}/lineitem.parquet")
    feeds = []
    plain = feed_standins._feed
    monkeypatch.setattr(feed_standins, "_feed", lambda *a, **k: feeds.append(plain(*a, **k)) or feeds[-1])
    got = feed_standins.us_event_statements(spark, sf).where("serial is not null and number is not null").collect()
    files = glob.glob(f"{feeds[0].removeprefix('file://')}/part-*")
    assert len(files) >= 4 and all(f.endswith(".gz") for f in files)
    expected = {}
    for k, n in lines[:100]:
        expected[k, str(n)] = expected.get((k, str(n)), 0) + 1
    assert {(r.serial, r.number): r.n for r in got} == expected


def test_landed_records_are_stored_packed_and_go(spark, monkeypatch):
    """A cache of parsed records took 30 times the bytes of packed files, on the executors' disks too (F2)."""
    plans = []
    plain = updates.save_family

    def saved(tables, folder):
        plans.extend(t._jdf.queryExecution().optimizedPlan().toString() for t in tables.values())
        plans.extend(t.inputFiles()[0] for t in tables.values())
        return plain(tables, folder)

    monkeypatch.setattr(updates, "save_family", saved)
    body = "<r>" + "".join(f"<case-file><serial-number>{i}</serial-number><case-file-header><filing-date>20010101</filing-date>"
                           "</case-file-header></case-file>" for i in range(9)) + "</r>"
    landing = work_dir(spark, "stored")
    updates.land_version(spark, US, _land(spark, "stored-xml", body), landing, "v1")
    assert updates.read_family(spark, updates.landed_families(spark, landing, "us")["v1"])["case-file-header"].count() == 9
    assert not any("InMemoryRelation" in x for x in plans)
    folders = {os.path.dirname(x.removeprefix("file://")) for x in plans if x.endswith(".parquet")}
    assert folders and not any(os.path.exists(x) for x in folders)


def test_a_landing_finds_its_ranges_once(spark, monkeypatch):
    calls = []
    plain = xml_records.record_ranges
    counted = lambda *a, **k: calls.append(a) or plain(*a, **k)
    monkeypatch.setattr(xml_records, "record_ranges", counted)
    monkeypatch.setattr(updates, "record_ranges", counted)
    body = "<r>" + "".join(f"<case-file><serial-number>{i}</serial-number><case-file-header><filing-date>20010101</filing-date>"
                           "</case-file-header></case-file>" for i in range(9)) + "</r>"
    landing = work_dir(spark, "once")
    updates.land_version(spark, US, _land(spark, "once-xml", body), landing, "v1")
    family = updates.read_family(spark, updates.landed_families(spark, landing, "us")["v1"])
    assert family["case-file-header"].count() == 9 and len(calls) == 1


def test_buckets_grow_with_the_table(spark, monkeypatch):
    monkeypatch.setattr(buckets, "stored_bytes", lambda *_: 640 << 20)
    assert buckets.bucket_count(spark, "x") >= 20


def test_conf_is_put_back(spark):
    with session_conf(spark, {"spark.sql.maxConcurrentOutputFileWriters": "4"}):
        pass
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters", "0") == "0"
