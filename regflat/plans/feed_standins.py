"""Queries that drive the pipeline from feed files to tables: landing, ledger, schemas, bad records.

The feeds are rendered from the driver tables as XML text; from there every
query goes through ``land_version`` / ``run_office`` as the command line does.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, functions as F

from regflat.plans.offices import GB, US, em_spec, separate_em
from regflat.plans import standins
from regflat.plans.snapshot import SnapshotStore
from regflat.plans.standins import naive, query, t, ymd
from regflat.plans.updates import LateVersion, apply_in_order, land_version, landed_families, quality_path, read_family, run_office
from regflat.operators.flatten import q
from regflat.session import work_dir
from regflat.sources.landing import table_folder
from regflat.sources.manifest import file_list, sort_manifest
from regflat.sources.xml_records import parse_strings, record_strings
from regflat.streaming.landed_versions import mark_landed, start as start_stream


def _element(tag: str, *parts: F.Column | str) -> F.Column:
    """``<tag>parts</tag>``, pretty-printed over several lines."""
    return F.concat(F.lit(f"<{tag}>\n"), *[F.lit(p) if isinstance(p, str) else p for p in parts], F.lit(f"</{tag}>\n"))


def _value(tag: str, c: F.Column) -> F.Column:
    return F.concat(F.lit(f"  <{tag}>"), c.cast("string"), F.lit(f"</{tag}>\n"))


def _feed(df: DataFrame, record: F.Column, purpose: str, packed: bool = False) -> str:
    """Write record texts below a fresh folder; returns it.  Packed: compressed files of ``LANDED_RECORDS`` records."""
    path = work_dir(df.sparkSession, purpose)
    writer = df.select(record.alias("value")).write
    if packed:
        writer = writer.option("compression", "gzip").option("maxRecordsPerFile", standins.LANDED_RECORDS)
    writer.text(path)
    return path


def _case(serial: F.Column, date: F.Column, *more: F.Column) -> F.Column:
    return _element("case-file", _value("serial-number", serial),
                    _element("case-file-header", _value("filing-date", date)), *more)


def _headers(store: SnapshotStore) -> DataFrame:
    return naive(store.current("case-file-header")).select(
        q("serial-number").cast("bigint").alias("serial"), q("filing-date").alias("filed"))


@query("late_version_applied", """
SELECT o_orderkey AS serial, CAST(CASE WHEN o_orderstatus = 'O' THEN o_orderdate + INTERVAL 1 DAY ELSE o_orderdate END AS TIMESTAMP) AS filed,
       TRUE AS late_refused
FROM orders
""")
def late_version_applied(spark, sf):
    """Versions are chosen by name: new ones go on after the ledger although their ranks in the listing have
    shifted, and one that sorts before a merged version is refused, not skipped."""
    o = t(spark, sf, "orders")
    landing, root = work_dir(spark, "late-land"), work_dir(spark, "late-store")
    first = _feed(o, _case(q("o_orderkey"), ymd(q("o_orderdate"))), "late-1")
    later = _feed(o.filter("o_orderstatus = 'O'"), _case(q("o_orderkey"), ymd(q("o_orderdate") + F.expr("INTERVAL 1 DAY"))), "late-3")
    run_office(spark, US, [("200100", 1, first), ("200101", 2, first)], landing, root)
    # the oldest folder is gone from the listing, a new version comes behind
    run_office(spark, US, [("200101", 1, first), ("200103", 2, later)], landing, root)
    try:
        run_office(spark, US, [("200101", 1, first), ("200102", 2, first), ("200103", 3, later)], landing, root)
        refused = False
    except LateVersion:
        refused = True
    return _headers(SnapshotStore(spark, root, "us", keys=US.keys)).withColumn("late_refused", F.lit(refused))


@query("partial_landing_retried", """
SELECT o_orderkey AS serial, CAST(o_orderdate AS TIMESTAMP) AS filed, 0 AS landed_before FROM orders
""")
def partial_landing_retried(spark, sf):
    """A landing without its marker (a crash after the first table) does not count and is landed again."""
    o = t(spark, sf, "orders")
    landing, root = work_dir(spark, "partial-land"), work_dir(spark, "partial-store")
    feed = _feed(o, _case(q("o_orderkey"), ymd(q("o_orderdate"))), "partial")
    o.limit(1).select(q("o_orderkey").cast("string").alias("serial-number")).write.parquet(
        table_folder(landing, "us", "v1", "case-file-header"))
    before = len(landed_families(spark, landing, "us"))
    run_office(spark, US, [("v1", 1, feed)], landing, root)
    return _headers(SnapshotStore(spark, root, "us", keys=US.keys)).withColumn("landed_before", F.lit(before))


@query("us_event_statements", """
SELECT l_orderkey AS serial, CAST(l_linenumber AS VARCHAR) AS number, count(*) AS n
FROM lineitem GROUP BY 1, 2
""")
def us_event_statements(spark, sf):
    """The largest US table is landed and merged like any other."""
    # a case goes on in further records, each with the statements of at most 2^17 neighbouring rows
    block = F.shiftright(F.monotonically_increasing_id(), 17)
    cases = t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", block.alias("block")).groupBy("l_orderkey", "block").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list("l_linenumber")), lambda n: _element(
            "case-file-event-statement", _value("number", n))), "").alias("events"))
    landing, root = work_dir(spark, "events-land"), work_dir(spark, "events-store")
    feed = _feed(cases, _case(q("l_orderkey"), F.lit("20010101"), _element("case-file-event-statements", q("events"))), "events", packed=True)
    run_office(spark, US, [("v1", 1, feed)], landing, root)
    found = SnapshotStore(spark, root, "us", keys=US.keys).current("case-file-event-statements")
    number = next(c for c in found.columns if c.endswith("number") and c != "serial-number")
    return found.groupBy(q("serial-number").cast("bigint").alias("serial"), q(number).cast("string").alias("number")) \
        .agg(F.count(F.lit(1)).alias("n"))


def _em_feed(spark, sf, table: str, tag: str, key_tag: str, key: str, extra: str) -> str:
    df = t(spark, sf, table)
    return _feed(df, _element(tag, _value(key_tag, q(key)), _value("Feature", q(extra))), f"em-{table}")


@query("em_schemas_apart", """
SELECT 'Applicant' AS "schema", 'Applicant' AS "table", CAST(c_custkey AS VARCHAR) AS key FROM customer
UNION ALL SELECT 'InternationalRegistration', 'InternationalRegistration', CAST(s_suppkey AS VARCHAR) FROM supplier
UNION ALL SELECT 'TradeMark', 'TradeMark', CAST(p_partkey AS VARCHAR) FROM part
""")
def em_schemas_apart(spark, sf):
    """Three EM schemas with one version name in one landing: each store holds its own tables only."""
    landing, root = work_dir(spark, "apart-land"), work_dir(spark, "apart-store")
    feeds = {"TradeMark": ("part", "TradeMark", "ApplicationNumber", "p_partkey", "p_brand"),
             "InternationalRegistration": ("supplier", "TradeMark", "ApplicationNumber", "s_suppkey", "s_nationkey"),
             "Applicant": ("customer", "Applicant", "ApplicantIdentifier", "c_custkey", "c_mktsegment")}
    parts = []
    for schema, (table, tag, key_tag, key, extra) in feeds.items():
        run_office(spark, em_spec(schema), [("v1", 1, _em_feed(spark, sf, table, tag, key_tag, key, extra))], landing, root)
    for schema, (_, _, key_tag, _, _) in feeds.items():
        store = SnapshotStore(spark, root, "em", schema, keys=(key_tag,))
        parts += [store.current(name).select(F.lit(schema).alias("schema"), F.lit(name).alias("table"), q(key_tag).alias("key"))
                  for name in store.tables()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query("stream_em_schemas", """
SELECT 'TradeMark' AS "schema", CAST(p_partkey AS VARCHAR) AS key, p_brand AS feature FROM part
UNION ALL
SELECT 'Applicant', CAST(c_custkey AS VARCHAR),
       CASE WHEN c_mktsegment = 'BUILDING' THEN CAST(c_nationkey AS VARCHAR) ELSE c_mktsegment END FROM customer
""")
def stream_em_schemas(spark, sf):
    """Two EM schemas with the same ranks stream side by side; the second version of one lands before its first."""
    landing, root = work_dir(spark, "em-stream-land"), work_dir(spark, "em-stream-store")
    part, customer = t(spark, sf, "part"), t(spark, sf, "customer")
    changed = customer.where(q("c_mktsegment") == "BUILDING").withColumn("c_mktsegment", q("c_nationkey").cast("string"))

    def feed(df, tag, key_tag, key, extra, version):
        return _feed(df, _element(tag, _value(key_tag, q(key)), _value("Feature", q(extra))), f"em-{tag}-{version}")

    feeds = {("TradeMark", "v1", 1): feed(part, "TradeMark", "ApplicationNumber", "p_partkey", "p_brand", "v1"),
             ("Applicant", "v2", 2): feed(changed, "Applicant", "ApplicantIdentifier", "c_custkey", "c_mktsegment", "v2"),
             ("Applicant", "v1", 1): feed(customer, "Applicant", "ApplicantIdentifier", "c_custkey", "c_mktsegment", "v1")}
    stores = {}
    for (schema, version, rank), xml in feeds.items():
        spec = em_spec(schema)
        land_version(spark, spec, xml, landing, version)
        mark_landed(spark, landing, "em", version, rank, schema)
        store = stores.setdefault(schema, SnapshotStore(spark, root, "em", schema, keys=spec.keys))
        # a stream that starts again goes on from its own checkpoint
        start_stream(spark, spec, landing, store, f"{root}/_stream/{schema}").awaitTermination()
    parts = [stores[schema].current(schema).select(F.lit(schema).alias("schema"), q(key).alias("key"), q("Feature").alias("feature"))
             for schema, key in (("TradeMark", "ApplicationNumber"), ("Applicant", "ApplicantIdentifier"))]
    return parts[0].unionByName(parts[1])


@query("em_ir_main", """
SELECT CAST(s_suppkey AS VARCHAR) AS ApplicationNumber, CAST(s_nationkey AS VARCHAR) AS Feature FROM supplier
""")
def em_ir_main(spark, sf):
    """International registrations come as trade-mark elements."""
    landing, root = work_dir(spark, "ir-land"), work_dir(spark, "ir-store")
    spec = em_spec("InternationalRegistration")
    land_version(spark, spec, _em_feed(spark, sf, "supplier", "TradeMark", "ApplicationNumber", "s_suppkey", "s_nationkey"), landing, "v1")
    store = SnapshotStore(spark, root, "em", "InternationalRegistration", keys=spec.keys)
    apply_in_order(store, spec, landing, [("v1", 1)])
    return store.current("InternationalRegistration").select("ApplicationNumber", "Feature")


@query("malformed_records", """
SELECT o_orderkey AS serial, o_orderstatus <> 'P' AS good FROM orders
""")
def malformed_records(spark, sf):
    """Records that do not parse go to the quarantine; their neighbours stay."""
    o = t(spark, sf, "orders")
    good = _element("case-file", _value("serial-number", q("o_orderkey")))
    bad = _element("case-file", F.concat(F.lit("  <serial-number>"), q("o_orderkey").cast("string"), F.lit("</serial-numbr>\n")))
    feed = _feed(o, F.when(q("o_orderstatus") == "P", bad).otherwise(good), "malformed")
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("serial-number", T.StringType())])
    quarantine = work_dir(spark, "quarantine")
    kept = parse_strings(record_strings(spark, feed, "case-file"), schema, on_bad="quarantine", quarantine=quarantine)
    lost = spark.read.parquet(quarantine).select(F.regexp_extract("record", r"<serial-number>(\d+)", 1).cast("bigint").alias("serial"))
    return kept.select(q("serial-number").cast("bigint").alias("serial"), F.lit(True).alias("good")) \
        .unionByName(lost.withColumn("good", F.lit(False)))


@query("xml_split_states", """
SELECT CAST(o_orderkey AS VARCHAR) AS serial, o_orderkey % 5 AS kind,
       CASE o_orderkey % 5 WHEN 0 THEN 'x' || o_orderstatus || 'y' WHEN 1 THEN '</case-file><case-file> <!-- ' || o_orderstatus || ' -->'
            WHEN 3 THEN o_orderstatus END AS note,
       CASE o_orderkey % 5 WHEN 2 THEN 'a>' || o_orderstatus || '<case-file>' WHEN 4 THEN '/' END AS mark
FROM orders
""")
def xml_split_states(spark, sf):
    """Records read from byte ranges that begin anywhere: inside comments, CDATA sections, quoted values and end tags."""
    o, status = t(spark, sf, "orders"), q("o_orderstatus")
    kind = q("o_orderkey") % 5
    key = q("o_orderkey").cast("string")
    # one way to hide or to write a record's end for each kind
    body = F.when(kind == 0, F.concat(F.lit("<case-file id='"), key, F.lit("'><note>x"), status, F.lit("<!-- </case-file> \" -->y</note></case-file>"))) \
        .when(kind == 1, F.concat(F.lit("<case-file id='"), key, F.lit("'><note><![CDATA[</case-file><case-file> <!-- "), status, F.lit(" -->]]></note></case-file>"))) \
        .when(kind == 2, F.concat(F.lit("<case-file id='"), key, F.lit("' mark='a>"), status, F.lit("&lt;case-file>'/>"))) \
        .when(kind == 3, F.concat(F.lit("<case-file\n id=\""), key, F.lit("\"><note>"), status, F.lit("</note></case-file \n>"))) \
        .otherwise(F.concat(F.lit("<!-- <case-file id='no'> --><case-file mark=\"/\" id='"), key, F.lit("'></case-file>")))
    feed = _feed(o, body, "split-states")
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField(c, T.StringType()) for c in ("@id", "@mark", "note")])
    # ranges far smaller than a block, and prime, so that they begin in every place
    found = parse_strings(record_strings(spark, feed, "case-file", range_bytes=10_007), schema)
    return found.select(q("@id").alias("serial"), (q("@id").cast("bigint") % 5).alias("kind"), q("note"), q("@mark").alias("mark"))


@query("manifest_tables", """
SELECT c_nationkey AS page, right(lpad(CAST(c_custkey AS VARCHAR), 9, '0'), 3) AS volume,
       'HIST_' || lpad(CAST(c_custkey AS VARCHAR), 9, '0') || '.zip' AS file_name, 0 AS part_rank FROM customer
UNION ALL
SELECT s_nationkey, CAST(s_suppkey AS VARCHAR), CASE WHEN s_suppkey = 1 THEN 'WEEKLY_1_fixed.zip'
       ELSE 'WEEKLY_' || CAST(s_suppkey AS VARCHAR) || '.zip' END, 1 FROM supplier
""")
def manifest_tables(spark, sf):
    """Listing pages (one per nation) with a weekly table (file, volume) and a historical one (file, date),
    the latter with an index and a schema file that do not count."""
    def table(rows: DataFrame, *head: str) -> F.Column:
        titles = "".join(f"<th>{h}</th>" for h in head)
        return F.concat(F.lit(f"<table class='t'>\n<thead><tr>{titles}</tr></thead>"), rows, F.lit("</table>"))

    def row(a: F.Column, b: F.Column) -> F.Column:
        return F.concat(F.lit("<tr>\n <td><a href='x'>"), a, F.lit("</a></td><td>"), b.cast("string"), F.lit("</td></tr>\n"))

    # a nation's listing goes on over pages of bounded length
    def pages_of(table: str, key: str) -> DataFrame:
        return t(spark, sf, table).withColumn("sheet", F.floor(F.col(key) / 1000))

    weekly = pages_of("supplier", "s_suppkey").groupBy(F.col("s_nationkey").alias("page"), "sheet").agg(F.array_join(F.collect_list(
        row(F.concat(F.lit("WEEKLY_"), F.col("s_suppkey").cast("string"), F.lit(".zip")), F.col("s_suppkey"))), "").alias("w"))
    number = F.lpad(F.col("c_custkey").cast("string"), 9, "0")
    old = pages_of("customer", "c_custkey").groupBy(F.col("c_nationkey").alias("page"), "sheet").agg(F.array_join(F.collect_list(
        row(F.concat(F.lit("HIST_"), number, F.lit(".zip")), F.lit("2019 &amp; before"))), "").alias("h"))
    other = row(F.lit("Schema_1.zip"), F.lit("")), row(F.lit("index.zip"), F.lit(""))
    pages = weekly.join(old, ["page", "sheet"], "full").select("page", F.concat(
        table(F.coalesce("w", F.lit("")), "File", "Volume"),
        table(F.concat(F.coalesce("h", F.lit("")), *other), "File", "Date and volume")).alias("html"))
    return sort_manifest(file_list(pages, keep=("page",), corrections={"WEEKLY_1.zip": "WEEKLY_1_fixed.zip"}))


def _gb_mark(number: F.Column, day: F.Column, text: F.Column) -> F.Column:
    return _element("TradeMark", _value("ApplicationNumber", number), _value("ApplicationDateTime", day),
                    _element("MarkSeriesDetails", _element("MarkSeriesItem", _value("MarkImageText", text))))


def _at_one_utc(day: F.Column) -> F.Column:
    """One o'clock UTC of a day, written with an offset of two hours."""
    return F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit("T03:00:00+02:00"))


@query("gb_family_landed", """
SELECT 'Application' AS "table", CAST(o_orderkey AS VARCHAR) AS key, CAST(o_orderdate AS TIMESTAMP) + INTERVAL 1 HOUR AS at, NULL AS text FROM orders
UNION ALL SELECT 'MarkSeriesDetails', CAST(o_orderkey AS VARCHAR), NULL, o_orderstatus FROM orders
""")
def gb_family_landed(spark, sf):
    """A GB version separated and written by one job, read back from the landing."""
    o = t(spark, sf, "orders")
    landing = work_dir(spark, "gb-family")
    land_version(spark, GB, _feed(o, _gb_mark(q("o_orderkey"), _at_one_utc(q("o_orderdate")), q("o_orderstatus")), "gb-family"), landing, "v1")
    family = read_family(spark, landed_families(spark, landing, "gb")["v1"])
    main = naive(family["Application"]).select(F.lit("Application").alias("table"), q("ApplicationNumber").alias("key"),
                                               q("ApplicationDateTime").alias("at"), F.lit(None).cast("string").alias("text"))
    series = family["MarkSeriesDetails"]
    text = next(c for c in series.columns if c.endswith("MarkImageText"))
    return main.unionByName(series.select(F.lit("MarkSeriesDetails").alias("table"), q("ApplicationNumber").alias("key"),
                                          q(text).alias("text")), allowMissingColumns=True)


@query("landing_quality", """
SELECT 'us' AS office, 'case-file-header' AS "table", 'filing-date' AS "column", 'us_date' AS rule,
       count(*) FILTER (WHERE o_orderstatus = 'P') AS n_bad FROM orders
UNION ALL
SELECT 'em', 'TradeMark', 'ApplicationDate', 'iso_date', count(*) FILTER (WHERE p_size % 4 = 0) FROM part
""")
def landing_quality(spark, sf):
    """Values that the type rules cannot read, counted by the job that lands the rows; records that come twice count once."""
    o, p = t(spark, sf, "orders"), t(spark, sf, "part")
    landing = work_dir(spark, "quality-land")
    day = F.when(q("o_orderstatus") == "P", F.lit("unknown")).otherwise(ymd(q("o_orderdate")))
    land_version(spark, US, _feed(o, _case(q("o_orderkey"), day), "quality-us"), landing, "v1")
    mark = _element("TradeMark", _value("ApplicationNumber", q("p_partkey")), _value("ApplicationDate", F.when(
        q("p_size") % 4 == 0, F.lit("20-1-1")).otherwise(F.lit("2020-01-01"))))
    land_version(spark, em_spec("TradeMark"), _feed(p, F.concat(mark, mark), "quality-em"), landing, "v1")
    parts = [spark.read.parquet(quality_path(landing, office, "v1", schema)).select(F.lit(office).alias("office"), "table", "column", "rule", "n_bad")
             for office, schema in (("us", "default"), ("em", "TradeMark"))]
    return parts[0].unionByName(parts[1])


@query("gb_phases_published", """
SELECT CAST(o_orderkey AS VARCHAR) AS key, CAST(o_orderdate AS TIMESTAMP) + CASE WHEN o_orderstatus = 'F' THEN INTERVAL 25 HOUR
       ELSE INTERVAL 1 HOUR END AS at, 2 AS merged FROM orders
""")
def gb_phases_published(spark, sf):
    """GB from landing to published files: a bulk version, then a daily one with changed marks.  The second run finds
    nothing to land or merge and, as GB does, publishes all the same."""
    o = t(spark, sf, "orders")
    landing, root, folder = work_dir(spark, "phases-land"), work_dir(spark, "phases-store"), work_dir(spark, "phases-out")
    bulk = _feed(o, _gb_mark(q("o_orderkey"), _at_one_utc(q("o_orderdate")), q("o_orderstatus")), "phases-bulk")
    daily = _feed(o.where("o_orderstatus = 'F'"), _gb_mark(
        q("o_orderkey"), _at_one_utc(q("o_orderdate") + F.expr("INTERVAL 1 DAY")), q("o_orderstatus")), "phases-daily")
    versions = [("daily__01", 2, daily), ("bulk__01", 1, bulk)]
    run_office(spark, GB, versions, landing, root)
    published = run_office(spark, GB, versions, landing, root, publish_folder=folder)
    merged = len(SnapshotStore(spark, root, "gb", keys=GB.keys).committed_versions())
    return naive(spark.read.parquet(published["Application"])).select(
        q("ApplicationNumber").alias("key"), q("ApplicationDateTime").alias("at"), F.lit(merged).alias("merged"))


@query("em_record_column", """
SELECT 'TradeMark' AS "table", CAST(p_partkey AS VARCHAR) AS key, p_brand AS feature FROM part
UNION ALL SELECT 'delete', 'gone-' || CAST(p_partkey AS VARCHAR), NULL FROM part WHERE p_size % 2 = 0
""")
def em_record_column(spark, sf):
    """Records inside a wrapping element: the separation is narrowed to their column and walks down to them."""
    p = t(spark, sf, "part")
    kept = _element("TradeMark operationCode='Insert'", _value("ApplicationNumber", q("p_partkey")), _value("Feature", q("p_brand")))
    gone = _element("TradeMark operationCode='Delete'", _value("ApplicationNumber", F.concat(F.lit("gone-"), q("p_partkey").cast("string"))))
    both = F.when(q("p_size") % 2 == 0, F.concat(gone, kept)).otherwise(kept)
    wrapped = F.regexp_replace(_element("TransactionData", _element("TradeMarkDetails", both)), "</TradeMark [^>]*>", "</TradeMark>")
    spec = replace(em_spec("TradeMark"), row_tag="TransactionData",
                   separate=lambda df: separate_em(df, record_column="TradeMarkDetails"))
    landing = work_dir(spark, "wrapped-land")
    land_version(spark, spec, _feed(p, wrapped, "wrapped"), landing, "v1")
    family = read_family(spark, landed_families(spark, landing, "em", "TradeMark")["v1"])
    return family["TradeMark"].select(F.lit("TradeMark").alias("table"), q("ApplicationNumber").alias("key"), q("Feature").alias("feature")) \
        .unionByName(family["delete"].select(F.lit("delete").alias("table"), q("ApplicationNumber").alias("key")), allowMissingColumns=True)
