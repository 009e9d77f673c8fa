"""Driver-table stand-ins for every operator.

The driver tables hold no register data, so each operator runs on a
stand-in derived from them with Spark (never on made-up input), over the
whole tables.  Each entry pairs the Spark query with an independent ANSI
SQL statement of the expected result, run by DuckDB on the same Parquet.

Timestamps leave the queries as ``timestamp_ntz`` (UTC wall clock) so they
compare with DuckDB's naive ``TIMESTAMP``.

Stand-in XML records are built row by row (one order, line, part or event
per record) and never by grouping children under a key: a key holding a
third of all rows would otherwise become one giant record built in one
task.  Repeated elements come from a row's own columns (two descriptions,
two classifications), so single-vs-repeated handling is still exercised.

Sections: U1 applications, J1-J5 merges, bulk/fold, F1/F2 flags, XML records
and the four office specs, N2/N3/JSON, P2-P6 names and pruning, K5-K9 types,
F3/F5/F6/D rows, S3 manifest, S8/S9/O3/F8 version lists, S11 ledger, L2/L4,
S4/W1-W5 Parquet, L5 snapshots and the stream, S6 landing, S2 archives, S10.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from regflat.functions.names import CA_NAMES, EM_NAMES, clean_names, rename_one, shorten_prefixes
from regflat.functions.types import (ISO_TYPE_RULES, US_TYPE_RULES, GB_TYPE_RULES, apply_type_rules,
                                     quality_counts)
from regflat.operators.flatten import flatten_fully, normalise_struct, q
from regflat.operators.key_screen import remove_keys_screened
from regflat.operators.merge import (VERSION_COL, TableVersion, bulk_merge, delete_replace,
                                     fold_merge, replace_by_key, update_table, align_union)
from regflat.operators.prune import CA_DROP, GB_DROP, US_UNNECESSARY, drop_by_rules, drop_present, select_present
from regflat.operators.rows import (distinct_keys, distinct_rows, drop_all_null_rows, drop_null_rows,
                                    filter_equals, live_rows, split_deletes)
from regflat.operators.separate import Cleaning, extract_partial, extract_subtree, finish_partial
from regflat.plans.applications import applications, write_applications
from regflat.plans.buckets import bucket_count, merge_bucketed, write_bucketed
from regflat.plans.catalog import catalog, column_statistics
from regflat.plans.ledger import latest, next_version as next_version_of, pending
from regflat.plans.offices import (CA, GB, US, OfficeSpec, normalise, prepare_new_rows, separate_em,
                                   separate_us)
from regflat.plans.publish import compact_files, compact_table, save_table
from regflat.plans import claims
from regflat.plans.snapshot import SnapshotStore
from regflat.session import work_dir
from regflat.sources.archive import expand_archives
from regflat.sources.codes import code_counts, read_codes, write_codes
from regflat.sources.landing import (daily_versions, historical_versions, inventory, landed_tables,
                                     order_versions, table_folder, unlanded)
from regflat.sources.manifest import anchors, concat_parts, manifest_rows, sort_manifest
from regflat.sources.xml_records import as_text_schema, parse_records, read_records
from regflat.streaming.landed_versions import mark_landed, start as start_stream

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf.rstrip('/')}/{name}.parquet")


def naive(df: DataFrame) -> DataFrame:
    """Cast instant timestamps to UTC wall-clock ``timestamp_ntz``."""
    exprs = [q(f.name).cast(T.TimestampNTZType()).alias(f.name)
             if isinstance(f.dataType, T.TimestampType) else q(f.name) for f in df.schema.fields]
    return df.select(*exprs)


def ymd(c) -> F.Column:
    return F.date_format(c, "yyyyMMdd")


REGISTRY: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}


def query(name: str, sql: str | None):
    def deco(fn):
        REGISTRY[name] = (fn, sql)
        return fn
    return deco


# ----------------------------------------------------------- U1 P8 K10 ----
def office_frames(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """Four office-shaped tables built from driver tables."""
    o = t(spark, sf, "orders")
    us = o.select(q("o_orderkey").cast("string").alias("serial-number"),
                  q("o_orderdate").alias("filing-date"),
                  F.when(q("o_orderstatus") == "F", q("o_orderdate") + F.expr("INTERVAL 30 DAYS"))
                  .alias("registration-date"))
    l = t(spark, sf, "lineitem")
    ca = l.select(F.concat_ws("-", q("l_orderkey").cast("string"), q("l_linenumber").cast("string"))
                  .alias("ApplicationNumber"), q("l_shipdate").alias("ApplicationDate"))
    em = t(spark, sf, "customer").select(q("c_custkey").cast("string").alias("ApplicationNumber"))
    gb = t(spark, sf, "events").select(q("event_id").cast("string").alias("ApplicationNumber"),
                                       q("ts").alias("ApplicationDateTime"), q("ts").alias("RegistrationDate"))
    return {"us": us, "ca": ca, "em": em, "gb": gb}


@query("applications_union", """
SELECT 'us' AS ip_office, CAST(o_orderkey AS VARCHAR) AS application_number,
       CAST(o_orderdate AS TIMESTAMP) AS application_date,
       CASE WHEN o_orderstatus = 'F' THEN o_orderdate + INTERVAL 30 DAY END AS registration_date
FROM orders
UNION ALL
SELECT 'ca', CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR), l_shipdate, NULL FROM lineitem
UNION ALL
SELECT 'em', CAST(c_custkey AS VARCHAR), NULL, NULL FROM customer
UNION ALL
SELECT 'gb', CAST(event_id AS VARCHAR), ts, ts FROM events
""")
def applications_union(spark, sf):
    return naive(applications(office_frames(spark, sf)))


@query("applications_published", REGISTRY["applications_union"][1])
def applications_published(spark, sf):
    """The unified table written by office folder and read back."""
    path = work_dir(spark, "unified")
    write_applications(office_frames(spark, sf), path)
    return naive(spark.read.parquet(path)).select("ip_office", "application_number", "application_date", "registration_date")


# ----------------------------------------------------------- J1-J5 U2 -----
def customer_delta(c: DataFrame) -> DataFrame:
    changed = c.filter(q("c_mktsegment") == "BUILDING").withColumn("c_acctbal", q("c_acctbal") + 1)
    new = c.filter(q("c_nationkey") == 0).withColumn("c_custkey", q("c_custkey") + 1000000)
    return changed.unionByName(new)


CUSTOMER_DELTA_SQL = """
delta AS (
  SELECT c_custkey, c_name, c_nationkey, c_acctbal + 1 AS c_acctbal, c_mktsegment
  FROM customer WHERE c_mktsegment = 'BUILDING'
  UNION ALL
  SELECT c_custkey + 1000000, c_name, c_nationkey, c_acctbal, c_mktsegment
  FROM customer WHERE c_nationkey = 0)"""


@query("merge_replace", f"""
WITH {CUSTOMER_DELTA_SQL}
SELECT * FROM customer c WHERE NOT EXISTS (SELECT 1 FROM delta d WHERE d.c_custkey = c.c_custkey)
UNION ALL SELECT * FROM delta
""")
def merge_replace(spark, sf):
    c = t(spark, sf, "customer")
    return replace_by_key(c, customer_delta(c), ["c_custkey"])


@query("merge_delete_replace", f"""
WITH {CUSTOMER_DELTA_SQL},
dels AS (SELECT c_custkey FROM customer WHERE c_nationkey IN (1, 2))
SELECT * FROM customer c
WHERE NOT EXISTS (SELECT 1 FROM dels x WHERE x.c_custkey = c.c_custkey)
  AND NOT EXISTS (SELECT 1 FROM delta d WHERE d.c_custkey = c.c_custkey)
UNION ALL SELECT * FROM delta
""")
def merge_delete_replace(spark, sf):
    c = t(spark, sf, "customer")
    # one landed version: live rows plus delete rows marked by a flag
    live = customer_delta(c).withColumn("op", F.lit("upsert"))
    dels = (c.filter(q("c_nationkey").isin(1, 2)).select("c_custkey")
            .withColumn("op", F.lit("delete")))
    version = align_union(live, dels)
    deletes = split_deletes(version, "op", "delete", ["c_custkey"])
    new = live_rows(version, "op", "delete").drop("op")
    return delete_replace(c, new, deletes, ["c_custkey"])


LINEITEM_COLS = ("l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, "
                 "l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate")


@query("merge_multi_row_key", """
WITH delta AS (
  SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity + 1 AS l_quantity, l_extendedprice,
         l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate
  FROM lineitem WHERE l_returnflag = 'R')
SELECT * FROM lineitem l WHERE NOT EXISTS (SELECT 1 FROM delta d WHERE d.l_orderkey = l.l_orderkey)
UNION ALL SELECT * FROM delta
""")
def merge_multi_row_key(spark, sf):
    l = t(spark, sf, "lineitem")
    delta = l.filter(q("l_returnflag") == "R").withColumn("l_quantity", q("l_quantity") + 1)
    return update_table(l, delta, ["l_orderkey"])


@query("merge_screened", """
WITH delta AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice + 1 AS o_totalprice, o_orderdate, o_orderpriority
  FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'P'),
dels AS (SELECT o_orderkey FROM orders WHERE o_orderpriority = '2-HIGH' AND o_orderstatus = 'F')
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders o
WHERE NOT EXISTS (SELECT 1 FROM dels x WHERE x.o_orderkey = o.o_orderkey)
  AND NOT EXISTS (SELECT 1 FROM delta d WHERE d.o_orderkey = o.o_orderkey)
UNION ALL SELECT * FROM delta
""")
def merge_screened(spark, sf):
    o = t(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
                                      "o_orderpriority")
    delta = (o.filter((q("o_orderpriority") == "1-URGENT") & (q("o_orderstatus") == "P"))
             .withColumn("o_totalprice", q("o_totalprice") + 1))
    deletes = o.filter((q("o_orderpriority") == "2-HIGH") & (q("o_orderstatus") == "F")).select("o_orderkey")
    return delete_replace(o, delta, deletes, ["o_orderkey"], remove_keys_screened)


@query("merge_bucketed", """
WITH delta AS (
  SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity + 1 AS l_quantity, l_extendedprice,
         l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate
  FROM lineitem WHERE l_returnflag = 'R'),
dels AS (SELECT l_orderkey FROM lineitem WHERE l_linenumber >= 5)
SELECT * FROM lineitem l
WHERE NOT EXISTS (SELECT 1 FROM dels x WHERE x.l_orderkey = l.l_orderkey)
  AND NOT EXISTS (SELECT 1 FROM delta d WHERE d.l_orderkey = l.l_orderkey)
UNION ALL SELECT * FROM delta
""")
def merge_bucketed_query(spark, sf):
    l = t(spark, sf, "lineitem")
    delta = l.filter(q("l_returnflag") == "R").withColumn("l_quantity", q("l_quantity") + 1)
    deletes = l.filter(q("l_linenumber") >= 5).select("l_orderkey")
    at = work_dir(spark, "bucketed")
    current = write_bucketed(l, f"{at}/0", ["l_orderkey"], bucket_count(spark, f"{sf.rstrip('/')}/lineitem.parquet"))
    return merge_bucketed(current, f"{at}/1", delta, deletes).rows()


@query("merge_schema_evolution", """
WITH delta AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice + 1 AS o_totalprice, o_orderdate,
         'clerk-' || CAST(o_custkey AS VARCHAR) AS o_clerk
  FROM orders WHERE o_orderstatus = 'P')
SELECT * FROM orders o WHERE NOT EXISTS (SELECT 1 FROM delta d WHERE d.o_orderkey = o.o_orderkey)
UNION ALL BY NAME SELECT * FROM delta
""")
def merge_schema_evolution(spark, sf):
    o = t(spark, sf, "orders")
    delta = (o.filter(q("o_orderstatus") == "P").drop("o_orderpriority")
             .withColumn("o_totalprice", q("o_totalprice") + 1)
             .withColumn("o_clerk", F.concat(F.lit("clerk-"), q("o_custkey").cast("string"))))
    return replace_by_key(o, delta, ["o_orderkey"])


NULL_SUPPLIER_SQL = """
old AS (SELECT CASE WHEN s_nationkey = 3 THEN NULL ELSE s_suppkey END AS s_suppkey,
               s_name, s_nationkey, s_acctbal FROM supplier),
delta AS (SELECT CASE WHEN s_nationkey = 3 THEN NULL ELSE s_suppkey END AS s_suppkey,
                 s_name, s_nationkey, s_acctbal + 1 AS s_acctbal
          FROM supplier WHERE s_nationkey IN (3, 4))"""


@query("merge_null_keys", f"""
WITH {NULL_SUPPLIER_SQL}
SELECT * FROM old o WHERE NOT EXISTS (SELECT 1 FROM delta d WHERE d.s_suppkey IS NOT DISTINCT FROM o.s_suppkey)
UNION ALL SELECT * FROM delta
""")
def merge_null_keys(spark, sf):
    s = t(spark, sf, "supplier")
    key = F.when(q("s_nationkey") == 3, F.lit(None)).otherwise(q("s_suppkey")).alias("s_suppkey")
    old = s.select(key, "s_name", "s_nationkey", "s_acctbal")
    delta = (s.filter(q("s_nationkey").isin(3, 4))
             .select(key, "s_name", "s_nationkey", (q("s_acctbal") + 1).alias("s_acctbal")))
    return replace_by_key(old, delta, ["s_suppkey"])


# ----------------------------------------------------------- bulk / fold --
ORDERS_VERSIONS_SQL = """
d AS (SELECT *, CAST(year(o_orderdate) AS INTEGER) AS version FROM orders),
cur AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority,
               -1 AS version FROM d WHERE o_orderstatus = 'P' OR (o_orderstatus = 'F' AND o_orderpriority <> '1-URGENT')),
up AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority, version
       FROM d WHERE o_orderstatus = 'O' AND version < (SELECT max(version) FROM d)),
dels AS (SELECT o_custkey, version FROM d
         WHERE ((o_orderstatus = 'F' AND o_orderpriority = '1-URGENT')
             OR (o_orderstatus = 'O' AND version = (SELECT max(version) FROM d)))
           AND version IN (SELECT DISTINCT version FROM up)),
allrows AS (SELECT * FROM cur UNION ALL SELECT * FROM up),
result AS (
  SELECT r.* FROM allrows r
  WHERE NOT EXISTS (SELECT 1 FROM allrows r2 WHERE r2.o_custkey = r.o_custkey AND r2.version > r.version)
    AND NOT EXISTS (SELECT 1 FROM dels x WHERE x.o_custkey = r.o_custkey AND x.version > r.version))"""


def orders_versions(spark, sf):
    """Every order has its part.  Versions = order years; current = status P
    and F that is not urgent; upserts = status O but for the newest year, from
    which the table is absent; deletes = customers of urgent F orders, and of
    the newest year's O orders (which reach no table)."""
    o = t(spark, sf, "orders").withColumn(VERSION_COL, F.year("o_orderdate").cast("int"))
    last = o.select(F.max(VERSION_COL)).scalar()  # scalar subquery, planned by Spark
    urgent = q("o_orderpriority") == "1-URGENT"
    current = o.filter((q("o_orderstatus") == "P") | ((q("o_orderstatus") == "F") & ~urgent)).drop(VERSION_COL)
    ups = o.filter((q("o_orderstatus") == "O") & (q(VERSION_COL) < last))
    present = ups.select(VERSION_COL).distinct()
    dels = (o.filter(((q("o_orderstatus") == "F") & urgent) | ((q("o_orderstatus") == "O") & (q(VERSION_COL) == last)))
            .select("o_custkey", VERSION_COL))
    return current, ups, dels, present


@query("bulk_merge", f"WITH {ORDERS_VERSIONS_SQL} SELECT * FROM result")
def bulk_merge_query(spark, sf):
    current, ups, dels, present = orders_versions(spark, sf)
    out = bulk_merge(current, ups, dels, present, ["o_custkey"])
    return out.withColumnRenamed(VERSION_COL, "version")


@query("fold_merge", f"""WITH {ORDERS_VERSIONS_SQL}
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM result""")
def fold_merge_query(spark, sf):
    current, ups, dels, present = orders_versions(spark, sf)
    ranks = sorted(r[0] for r in present.collect())  # version listing: a handful of years
    versions = [TableVersion(r, ups.filter(q(VERSION_COL) == r).drop(VERSION_COL),
                             dels.filter(q(VERSION_COL) == r).drop(VERSION_COL)) for r in ranks]
    return fold_merge(current, versions, ["o_custkey"], checkpoint_every=4)


# ----------------------------------------------------------- F1 F2 --------
@query("live_rows_null_flag", """
WITH o AS (SELECT o_orderkey, o_custkey,
                  CASE WHEN o_orderpriority = '3-MEDIUM' THEN NULL ELSE o_orderstatus END AS o_orderstatus,
                  o_totalprice, o_orderdate, o_orderpriority FROM orders)
SELECT * FROM o WHERE o_orderstatus IS DISTINCT FROM 'F'
""")
def live_rows_null_flag(spark, sf):
    o = t(spark, sf, "orders").withColumn(
        "o_orderstatus", F.when(q("o_orderpriority") == "3-MEDIUM", F.lit(None)).otherwise(q("o_orderstatus")))
    return live_rows(o, "o_orderstatus", "F")


@query("split_deletes", "SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F'")
def split_deletes_query(spark, sf):
    return split_deletes(t(spark, sf, "orders"), "o_orderstatus", "F", ["o_orderkey"])


# ----------------------------------------------------------- XML ----------
def _land_xml(spark, df: DataFrame, row_tag: str, purpose: str) -> tuple[str, T.StructType]:
    """Land stand-in records as XML (the "download") and keep their reading
    schema, as a pipeline stores it beside the ledger.

    Records are rendered by ``to_xml`` and read by the pipeline's own reader."""
    path = work_dir(spark, purpose)
    _write_records(df, F.to_xml(F.struct(*[q(c) for c in df.columns]),
                                {"rowTag": row_tag, "attributePrefix": "@", "valueTag": "#text", "indent": ""}), path)
    return path, as_text_schema(df.schema)


LANDED_RECORDS = 50_000  # of a landed file: compressed files are read whole, each by one task


def _write_records(df: DataFrame, xml: F.Column, path: str) -> None:
    """Land record texts as an office packs them: compressed files of bounded length (plain, indented text is tens of
    times the tables that it comes from)."""
    df.select(xml.alias("record")).write.option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED") \
        .option("maxRecordsPerFile", LANDED_RECORDS).text(path)


def _prefixed(dtype: T.DataType) -> T.DataType:
    """Schema with ``ns__name`` placeholders turned back into ``ns:name``."""
    if isinstance(dtype, T.StructType):
        return T.StructType([T.StructField(f.name.replace("__", ":"), _prefixed(f.dataType), True)
                             for f in dtype.fields])
    if isinstance(dtype, T.ArrayType):
        return T.ArrayType(_prefixed(dtype.elementType), True)
    return dtype


def _read_landed_prefixed(spark, df: DataFrame, row_tag: str, purpose: str, sf: str) -> DataFrame:
    """Like :func:`_read_landed` for namespace-prefixed records: Spark's XML
    writer refuses ``:`` in names, so records are rendered with ``ns__name``
    placeholders by ``to_xml`` and the prefixes restored by a regex."""
    path = work_dir(spark, purpose)
    xml = F.to_xml(F.struct(*[q(c) for c in df.columns]),
                   {"rowTag": row_tag.replace(":", "__"), "attributePrefix": "@", "valueTag": "#text", "indent": ""})
    # element names, and names before an equals sign (attributes); the search is for the two signs, so it is one quick pass
    name = "(?:tmk|com|cacom|catmk)__"
    xml = F.regexp_replace(xml, rf"__(?:(?<=<{name})|(?<=</{name})|(?<=\s{name})(?=[A-Za-z0-9]+=))", ":")
    _write_records(df, xml, path)
    return read_records(spark, path, row_tag, _prefixed(as_text_schema(df.schema)))


def _read_landed(spark, df: DataFrame, row_tag: str, purpose: str, sf: str) -> DataFrame:
    path, schema = _land_xml(spark, df, row_tag, purpose)
    return read_records(spark, path, row_tag, schema)


@query("xml_scan_flatten", """
SELECT o.o_orderkey AS o_orderkey, o.o_custkey AS o_custkey, o.o_orderstatus AS o_orderstatus,
       strftime(o.o_orderdate, '%Y%m%d') AS o_orderdate,
       l.l_linenumber AS "line|l_linenumber", l.l_quantity AS "line|l_quantity",
       l.l_returnflag AS "line|l_returnflag"
FROM orders o JOIN lineitem l ON l.l_orderkey = o.o_orderkey
""")
def xml_scan_flatten(spark, sf):
    o, l = t(spark, sf, "orders"), t(spark, sf, "lineitem")
    recs = o.join(l, l.l_orderkey == o.o_orderkey).select(
        "o_orderkey", "o_custkey", "o_orderstatus", ymd(q("o_orderdate")).alias("o_orderdate"),
        F.array(F.struct("l_linenumber", "l_quantity", "l_returnflag")).alias("line"))
    flat = flatten_fully(_read_landed(spark, recs, "order", "xml-scan", sf))
    return flat.select(q("o_orderkey").cast("bigint").alias("o_orderkey"),
                       q("o_custkey").cast("bigint").alias("o_custkey"), "o_orderstatus", "o_orderdate",
                       q("line|l_linenumber").cast("int").alias("line|l_linenumber"),
                       q("line|l_quantity").cast("double").alias("line|l_quantity"),
                       q("line|l_returnflag"))


@query("xml_attribute_text", """
SELECT p_partkey, p_name AS "p_name|text", p_brand AS "p_name|brand",
       p_type AS "p_type|text", p_size AS "p_type|size" FROM part
""")
def xml_attribute_text(spark, sf):
    p = t(spark, sf, "part")
    recs = p.select("p_partkey",
                    F.struct(q("p_name").alias("#text"), q("p_brand").alias("@brand")).alias("p_name"),
                    F.struct(q("p_type").alias("#text"), q("p_size").alias("@size")).alias("p_type"))
    flat = flatten_fully(_read_landed(spark, recs, "part", "xml-attr", sf))
    flat = clean_names(flat, EM_NAMES)
    return flat.select(q("p_partkey").cast("bigint").alias("p_partkey"), q("p_name|text"),
                       q("p_name|brand"), q("p_type|text"),
                       q("p_type|size").cast("int").alias("p_type|size"))


def em_records(spark, sf) -> DataFrame:
    """EM-shaped TradeMark records, one per order line; F orders are deletes."""
    o, l = t(spark, sf, "orders"), t(spark, sf, "lineitem")
    recs = o.join(l, l.l_orderkey == o.o_orderkey).select(
        F.when(q("o_orderstatus") == "F", F.lit("Delete")).alias("@operationCode"),
        q("o_orderkey").alias("ApplicationNumber"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("ApplicationDate"),
        q("o_orderpriority").alias("MarkFeature"),
        F.struct(F.struct(q("l_linenumber").alias("LineNumber"),
                          q("l_quantity").alias("Quantity")).alias("Line")).alias("LineDetails"))
    return _read_landed(spark, recs, "TradeMark", "xml-em", sf)


def em_tables(spark, sf) -> dict[str, DataFrame]:
    return separate_em(clean_names(em_records(spark, sf), EM_NAMES))


@query("separate_tables_main", """
SELECT DISTINCT o_orderkey AS ApplicationNumber, CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) AS ApplicationDate,
       o_orderpriority AS MarkFeature, CAST(NULL AS VARCHAR) AS operationCode
FROM orders o JOIN lineitem l ON l.l_orderkey = o.o_orderkey WHERE o.o_orderstatus <> 'F'
""")
def separate_tables_main(spark, sf):
    m = em_tables(spark, sf)["TradeMark"]
    return naive(m.select(q("ApplicationNumber").cast("bigint").alias("ApplicationNumber"),
                          "ApplicationDate", "MarkFeature", "operationCode"))


@query("separate_tables_line", """
SELECT DISTINCT o_orderkey AS ApplicationNumber, l_linenumber AS LineNumber, l_quantity AS Quantity
FROM orders o JOIN lineitem l ON l.l_orderkey = o.o_orderkey WHERE o.o_orderstatus <> 'F'
""")
def separate_tables_line(spark, sf):
    m = em_tables(spark, sf)["TradeMark.Line"]
    return m.select(q("ApplicationNumber").cast("bigint").alias("ApplicationNumber"),
                    q("LineNumber").cast("int").alias("LineNumber"),
                    q("Quantity").cast("double").alias("Quantity"))


@query("separate_tables_delete", """
SELECT 'Delete' AS operationCode, o_orderkey AS ApplicationNumber
FROM orders o JOIN lineitem l ON l.l_orderkey = o.o_orderkey WHERE o.o_orderstatus = 'F'
""")
def separate_tables_delete(spark, sf):
    d = em_tables(spark, sf)["delete"]
    return d.select("operationCode", q("ApplicationNumber").cast("bigint").alias("ApplicationNumber"))


def em_goods_records(spark, sf) -> DataFrame:
    """EM TradeMark records with goods and services: one per part, class =
    size, descriptions in two languages (name in en, type in fr)."""
    p = t(spark, sf, "part")
    desc = F.array(F.struct(q("p_name").alias("#text"), F.lit("en").alias("@languageCode")),
                   F.struct(q("p_type").alias("#text"), F.lit("fr").alias("@languageCode")))
    recs = p.select(q("p_partkey").alias("ApplicationNumber"), F.struct(F.array(F.struct(
        q("p_size").alias("ClassNumber"), q("p_brand").alias("ClassificationVersion"),
        F.struct(F.struct(desc.alias("GoodsServicesDescription")).alias("ClassDescription"))
        .alias("ClassDescriptionDetails"))).alias("GoodsServices")).alias("GoodsServicesDetails"))
    return _read_landed(spark, recs, "TradeMark", "xml-em-goods", sf)


@query("em_goods_services", """
SELECT DISTINCT CAST(NULL AS VARCHAR) AS operationCode, CAST(p_partkey AS VARCHAR) AS ApplicationNumber, CAST(p_size AS VARCHAR) AS ClassNumber,
       p_brand AS ClassificationVersion FROM part
""")
def em_goods_services(spark, sf):
    return separate_em(clean_names(em_goods_records(spark, sf), EM_NAMES))["TradeMark.GoodsServices"]


@query("em_goods_description", """
SELECT DISTINCT CAST(NULL AS VARCHAR) AS operationCode, CAST(p_partkey AS VARCHAR) AS ApplicationNumber, p_name AS "GoodsServicesDescription|text",
       'en' AS "GoodsServicesDescription|languageCode" FROM part
""")
def em_goods_description(spark, sf):
    fam = separate_em(clean_names(em_goods_records(spark, sf), EM_NAMES))
    return fam["TradeMark.GoodsServices.Description"]


def proceeding_records(spark, sf) -> DataFrame:
    """Two-level CA-like record: proceedings with stages, one per line item."""
    l = t(spark, sf, "lineitem")
    recs = l.select(q("l_orderkey").alias("ApplicationNumber"), F.struct(F.struct(
        q("l_linenumber").alias("ProceedingIdentifier"),
        F.struct(F.struct(q("l_returnflag").alias("StageCode"),
                          q("l_linestatus").alias("StageStatus")).alias("Stage")).alias("StageBag"))
        .alias("Proceeding")).alias("ProceedingBag"))
    return _read_landed(spark, recs, "Trademark", "xml-partial", sf)


PROCEEDING_CLEAN = Cleaning(CA_NAMES, CA_DROP, tuple(ISO_TYPE_RULES), rename_prefixes=True)


def proceedings_partial(spark, sf) -> DataFrame:
    """The proceedings container flattened two steps, names cleaned."""
    return extract_partial(proceeding_records(spark, sf), "ProceedingBag", ["ApplicationNumber"], 2,
                           PROCEEDING_CLEAN)


@query("partial_subtree", """
SELECT DISTINCT l_orderkey AS ApplicationNumber, l_linenumber AS ProceedingIdentifier,
       l_returnflag AS StageCode, l_linestatus AS StageStatus FROM lineitem
""")
def partial_subtree(spark, sf):
    part = proceedings_partial(spark, sf)
    keys = ["ApplicationNumber"]
    stages = extract_subtree(part, "StageBag", keys + ["ProceedingIdentifier"], PROCEEDING_CLEAN,
                             null_except=keys)
    return stages.select(q("ApplicationNumber").cast("bigint").alias("ApplicationNumber"),
                         q("ProceedingIdentifier").cast("int").alias("ProceedingIdentifier"),
                         "StageCode", "StageStatus")


@query("partial_subtree_rest", """
SELECT DISTINCT l_orderkey AS ApplicationNumber, l_linenumber AS ProceedingIdentifier FROM lineitem
""")
def partial_subtree_rest(spark, sf):
    """What is left of the container once its sub-tree went to its own table."""
    rest = finish_partial(proceedings_partial(spark, sf).drop("StageBag"), "ProceedingBag",
                          ["ApplicationNumber"], PROCEEDING_CLEAN)
    return rest.select(q("ApplicationNumber").cast("bigint").alias("ApplicationNumber"),
                       q("ProceedingIdentifier").cast("int").alias("ProceedingIdentifier"))


def us_records(spark, sf) -> DataFrame:
    """US-shaped case-file records, one per order, 1 or 2 classifications."""
    o = t(spark, sf, "orders")
    first = F.struct(F.substring("o_orderpriority", 1, 1).alias("international-code"),
                     q("o_custkey").cast("string").alias("us-code"),
                     q("o_orderstatus").alias("status-code"))
    second = F.when(q("o_orderstatus") != "P", F.struct(
        F.lit("0").alias("international-code"), F.lit("1").alias("us-code"),
        q("o_orderstatus").alias("status-code")))
    recs = o.select(
        q("o_orderkey").alias("serial-number"),
        F.struct(ymd(q("o_orderdate")).alias("filing-date"),
                 F.when(q("o_orderstatus") == "F", ymd(q("o_orderdate") + F.expr("INTERVAL 30 DAYS")))
                 .alias("registration-date"),
                 q("o_orderstatus").alias("status-code"),
                 F.when(q("o_orderpriority") == "1-URGENT", F.lit("T"))
                 .when(q("o_orderpriority") == "5-LOW", F.lit(None)).otherwise(F.lit("F"))
                 .alias("priority-in")).alias("case-file-header"),
        F.struct(F.filter(F.array(first, second), lambda x: x.isNotNull()).alias("classification"))
        .alias("classifications"))
    return _read_landed(spark, recs, "case-file", "xml-us", sf)


@query("us_case_file_header", """
SELECT o_orderkey AS "serial-number", CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) AS "filing-date",
       CASE WHEN o_orderstatus = 'F' THEN CAST(CAST(o_orderdate AS DATE) + INTERVAL 30 DAY AS TIMESTAMP) END
         AS "registration-date",
       o_orderstatus AS "status-code",
       CASE WHEN o_orderpriority = '1-URGENT' THEN true ELSE false END AS "priority-in"
FROM orders
""")
def us_case_file_header(spark, sf):
    h = separate_us(us_records(spark, sf))["case-file-header"]
    return naive(h.select(q("serial-number").cast("bigint").alias("serial-number"), q("filing-date"),
                          q("registration-date"), q("status-code"), q("priority-in")))


@query("us_classifications", """
SELECT DISTINCT o_orderkey AS "serial-number", substr(o_orderpriority, 1, 1) AS "classification|international-code",
       o_orderstatus AS "classification|status-code" FROM orders
UNION
SELECT o_orderkey, '0', o_orderstatus FROM orders WHERE o_orderstatus <> 'P'
""")
def us_classifications(spark, sf):
    c = separate_us(us_records(spark, sf))["classifications"]
    c = prepare_new_rows(US, "classifications", c)   # P3 + D1 as applied before merge
    return c.select(q("serial-number").cast("bigint").alias("serial-number"),
                    q("classification|international-code"), q("classification|status-code"))


def ca_records(spark, sf) -> DataFrame:
    """CA-shaped, namespace-prefixed Trademark records: one per order, the
    customer as applicant; urgent F orders are deletions."""
    o, c = t(spark, sf, "orders"), t(spark, sf, "customer")
    n = lambda name: name.replace(":", "__")  # noqa: E731  placeholder names, see _read_landed_prefixed
    recs = o.join(c, o.o_custkey == c.c_custkey).select(
        F.when((q("o_orderstatus") == "F") & (q("o_orderpriority") == "1-URGENT"), F.lit("delete"))
        .otherwise(F.lit("create")).alias(n("@com:operationCategory")),
        F.struct(q("o_orderkey").alias(n("com:ST13ApplicationNumber"))).alias(n("com:ApplicationNumber")),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias(n("tmk:ApplicationDate")),
        F.struct(F.array(F.struct(q("c_name").alias(n("com:LegalEntityName")),
                                  q("c_mktsegment").alias(n("com:EntitySegment")))).alias(n("tmk:Applicant")))
        .alias(n("tmk:ApplicantBag")),
        F.struct(F.struct(
            F.struct(F.struct(F.substring("o_orderpriority", 1, 1).alias(n("tmk:ClassNumber")))
                     .alias(n("tmk:ClassDescription"))).alias(n("tmk:ClassDescriptionBag")),
            q("o_orderpriority").alias(n("tmk:Note"))).alias(n("tmk:GoodsServices"))).alias(n("tmk:GoodsServicesBag")),
        F.struct(F.struct(F.struct(q("o_orderstatus").alias(n("tmk:MarkEventCategory")))
                          .alias(n("tmk:NationalMarkEvent"))).alias(n("tmk:MarkEvent"))).alias(n("tmk:MarkEventBag")))
    return _read_landed_prefixed(spark, recs, "tmk:Trademark", "xml-ca", sf)


def ca_tables(spark, sf) -> dict[str, DataFrame]:
    return normalise(CA, ca_records(spark, sf))


CA_LIVE_SQL = """FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
WHERE NOT (o.o_orderstatus = 'F' AND o.o_orderpriority = '1-URGENT')"""


@query("ca_trademark", f"""
SELECT 'create' AS operationCategory, CAST(o_orderkey AS VARCHAR) AS ApplicationNumber,
       CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) AS ApplicationDate {CA_LIVE_SQL}
""")
def ca_trademark(spark, sf):
    return naive(ca_tables(spark, sf)["Trademark"])


@query("ca_applicant", f"""
SELECT 'create' AS operationCategory, CAST(o_orderkey AS VARCHAR) AS ApplicationNumber,
       c_name AS LegalEntityName, c_mktsegment AS EntitySegment {CA_LIVE_SQL}
""")
def ca_applicant(spark, sf):
    return ca_tables(spark, sf)["Applicant"]


@query("ca_goods_services", f"""
SELECT 'create' AS operationCategory, CAST(o_orderkey AS VARCHAR) AS ApplicationNumber,
       substr(o_orderpriority, 1, 1) AS ClassNumber, o_orderpriority AS Note {CA_LIVE_SQL}
""")
def ca_goods_services(spark, sf):
    fam = ca_tables(spark, sf)
    classes = fam["GoodsServices.ClassDescription"]
    return classes.join(fam["GoodsServices"], ["operationCategory", "ApplicationNumber"])


# The table prefix is stripped after the partial extract and again when the
# tree is finished; the second pass removes the first "MarkEvent|" it finds,
# inside "NationalMarkEvent|", as the published name rule does.
@query("ca_mark_event", f"""
SELECT 'create' AS operationCategory, CAST(o_orderkey AS VARCHAR) AS ApplicationNumber,
       o_orderstatus AS NationalMarkEventCategory {CA_LIVE_SQL}
""")
def ca_mark_event(spark, sf):
    return ca_tables(spark, sf)["MarkEvent"]


@query("ca_delete", """
SELECT 'delete' AS operationCategory, CAST(o_orderkey AS VARCHAR) AS ApplicationNumber
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
WHERE o.o_orderstatus = 'F' AND o.o_orderpriority = '1-URGENT'
""")
def ca_delete(spark, sf):
    return ca_tables(spark, sf)["delete"]


def gb_records(spark, sf) -> DataFrame:
    """GB-shaped TradeMark records, one per event."""
    e = t(spark, sf, "events")
    offset = F.when(q("event_type") == "click", F.lit("+01:00")).otherwise(F.lit("Z"))
    recs = e.select(
        q("event_id").alias("ApplicationNumber"),
        F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), offset).alias("ApplicationDateTime"),
        F.struct(F.struct(q("props").alias("Blob")).alias("MarkImage")).alias("MarkImageDetails"),
        F.struct(F.struct(q("event_type").alias("Mark3DModelRef"), q("props").alias("MarkImageRef"),
                          q("event_type").alias("MarkImageText")).alias("MarkSeriesItem"))
        .alias("MarkSeriesDetails"),
        F.struct(F.array(F.struct(q("user_id").alias("UserId"), q("value").alias("Value"))).alias("User"))
        .alias("UserDetails"))
    return _read_landed(spark, recs, "TradeMark", "xml-gb", sf)


@query("gb_application", """
SELECT CAST(event_id AS VARCHAR) AS ApplicationNumber,
       date_trunc('second', ts) - CASE WHEN event_type = 'click' THEN INTERVAL 1 HOUR ELSE INTERVAL 0 HOUR END
         AS ApplicationDateTime
FROM events
""")
def gb_application(spark, sf):
    return naive(normalise(GB, gb_records(spark, sf))["Application"])


@query("gb_mark_series", """
SELECT CAST(event_id AS VARCHAR) AS ApplicationNumber, event_type AS "MarkSeriesDetails|MarkSeriesItem|MarkImageText"
FROM events
""")
def gb_mark_series(spark, sf):
    return normalise(GB, gb_records(spark, sf))["MarkSeriesDetails"]


@query("gb_user_details", """
SELECT CAST(event_id AS VARCHAR) AS ApplicationNumber, user_id AS "UserDetails|User|UserId",
       value AS "UserDetails|User|Value" FROM events
""")
def gb_user_details(spark, sf):
    u = normalise(GB, gb_records(spark, sf))["UserDetails"]
    return u.select("ApplicationNumber", q("UserDetails|User|UserId").cast("bigint").alias("UserDetails|User|UserId"),
                    q("UserDetails|User|Value").cast("double").alias("UserDetails|User|Value"))


@query("applications_from_offices", """
SELECT 'us' AS ip_office, CAST(o_orderkey AS VARCHAR) AS application_number,
       CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) AS application_date,
       CASE WHEN o_orderstatus = 'F' THEN CAST(CAST(o_orderdate AS DATE) + INTERVAL 30 DAY AS TIMESTAMP) END
         AS registration_date
FROM orders
UNION ALL
SELECT 'ca', CAST(o_orderkey AS VARCHAR), CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP), NULL
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
WHERE NOT (o.o_orderstatus = 'F' AND o.o_orderpriority = '1-URGENT')
UNION ALL
SELECT DISTINCT 'em', CAST(o_orderkey AS VARCHAR), CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP), NULL
FROM orders o JOIN lineitem l ON l.l_orderkey = o.o_orderkey WHERE o.o_orderstatus <> 'F'
UNION ALL
SELECT 'gb', CAST(event_id AS VARCHAR),
       date_trunc('second', ts) - CASE WHEN event_type = 'click' THEN INTERVAL 1 HOUR ELSE INTERVAL 0 HOUR END,
       NULL
FROM events
""")
def applications_from_offices(spark, sf):
    """Flagship: four offices' records through their specs, unified."""
    frames = {"us": separate_us(us_records(spark, sf))["case-file-header"],
              "ca": ca_tables(spark, sf)["Trademark"],
              "em": em_tables(spark, sf)["TradeMark"],
              "gb": normalise(GB, gb_records(spark, sf))["Application"]}
    return naive(applications(frames))


# ----------------------------------------------------------- N2 N3 JSON ---
@query("flatten_cross_product", """
SELECT c_custkey, n AS names, m AS codes
FROM customer, unnest([c_name, c_mktsegment]) AS t(n),
     unnest([CAST(c_nationkey AS VARCHAR), CAST(c_custkey AS VARCHAR)]) AS u(m)
""")
def flatten_cross_product(spark, sf):
    c = t(spark, sf, "customer")
    nested = c.select("c_custkey", F.array("c_name", "c_mktsegment").alias("names"),
                      F.array(q("c_nationkey").cast("string"), q("c_custkey").cast("string")).alias("codes"))
    return flatten_fully(nested)


@query("normalise_struct", """
SELECT c_custkey, c_name AS CustomerName, c_mktsegment AS "Customer|Segment" FROM customer
""")
def normalise_struct_query(spark, sf):
    c = t(spark, sf, "customer").select(
        "c_custkey", F.struct(q("c_name").alias("Name"), q("c_mktsegment").alias("Segment")).alias("Customer"))
    return rename_one(normalise_struct(c, "Customer"), "Customer|Name", "CustomerName")


@query("json_props_flatten", """
SELECT event_id, json_extract_string(props, '$.k') AS "props|k" FROM events
""")
def json_props_flatten(spark, sf):
    e = t(spark, sf, "events")
    # a declared schema, so that the width of the table does not depend on the data
    schema = T.StructType([T.StructField("k", T.StringType())])
    nested = e.select("event_id", F.from_json("props", schema).alias("props"))
    return flatten_fully(nested)


# ----------------------------------------------------------- P2-P6 --------
@query("clean_names", """
SELECT p_partkey AS "ApplicationNumber|ST13ApplicationNumber", p_name AS LegalEntityName,
       p_retailprice AS "FeeAmount|text", p_type AS "Text",
       p_brand AS "WordMarkSpecification|MarkVerbalElementText", p_size AS MarkDescription FROM part
""")
def clean_names_query(spark, sf):
    p = t(spark, sf, "part").select(
        q("p_partkey").alias("com:ApplicationNumber|com:ST13ApplicationNumber"),
        q("p_name").alias("tmk:ApplicantBag|tmk:Applicant|com:LegalEntityName"),
        q("p_retailprice").alias("cacom:FeeAmount|#text"),
        q("p_type").alias("tmk:Text|"),
        q("p_brand").alias("MarkReproduction|WordMarkSpecification|MarkVerbalElementText"),
        q("p_size").alias("MarkDescriptionBag|MarkDescription"))
    return shorten_prefixes(clean_names(p, CA_NAMES, "ApplicantBag"), CA_NAMES)


@query("prune_columns", """
SELECT p_partkey AS ApplicationNumber, p_name AS MarkVerbalElementText, p_retailprice AS FeeAmount,
       p_type AS "MarkSeriesDetails|MarkSeriesItem|MarkImageCategoryText" FROM part
""")
def prune_columns(spark, sf):
    p = t(spark, sf, "part").select(
        q("p_partkey").alias("ApplicationNumber"),
        q("p_name").alias("MarkVerbalElementText"),
        q("p_brand").alias("GoodsServicesClassificationKindCode"),
        q("p_type").alias("NationalMarkEvent|type"),
        q("p_size").alias("MarkImageFileFormat"),
        q("p_retailprice").alias("FeeAmount"),
        q("p_type").alias("MarkSeriesDetails|MarkSeriesItem|MarkImageCategoryText"),
        q("p_size").alias("MarkSeriesDetails|MarkSeriesItem|MarkImageFileSize"),
        q("p_name").alias("action-key"))
    p = drop_by_rules(drop_by_rules(p, CA_DROP), GB_DROP)
    return drop_present(p, US_UNNECESSARY)


# ----------------------------------------------------------- K5-K9 --------
def compact_date_input(spark, sf) -> DataFrame:
    o = t(spark, sf, "orders")
    good = ymd(q("o_orderdate"))
    text = (F.when(q("o_orderpriority") == "5-LOW", F.substring(good, 1, 7))
            .when(q("o_orderpriority") == "4-NOT SPECIFIED",
                  F.concat(F.date_format("o_orderdate", "yyyy"), F.lit("13"), F.date_format("o_orderdate", "dd")))
            .otherwise(good))
    return o.select("o_orderkey", text.alias("filing-date"))


COMPACT_SQL = """
t AS (SELECT o_orderkey,
             CASE WHEN o_orderpriority = '5-LOW' THEN substr(strftime(o_orderdate, '%Y%m%d'), 1, 7)
                  WHEN o_orderpriority = '4-NOT SPECIFIED'
                    THEN strftime(o_orderdate, '%Y') || '13' || strftime(o_orderdate, '%d')
                  ELSE strftime(o_orderdate, '%Y%m%d') END AS s FROM orders)"""


@query("coerce_dates_compact", f"""
WITH {COMPACT_SQL}
SELECT o_orderkey, CASE WHEN regexp_full_match(s, '[0-9]{{8}}') THEN try_strptime(s, '%Y%m%d') END AS "filing-date"
FROM t
""")
def coerce_dates_compact(spark, sf):
    return naive(apply_type_rules(compact_date_input(spark, sf), US_TYPE_RULES))


@query("coerce_dates_iso", """
SELECT o_orderkey, CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN NULL
                        ELSE CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) END AS ApplicationDate
FROM orders
""")
def coerce_dates_iso(spark, sf):
    o = t(spark, sf, "orders")
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    text = (F.when(q("o_orderpriority") == "5-LOW", F.concat(day, F.lit("-04:00")))
            .when(q("o_orderpriority") == "4-NOT SPECIFIED", F.lit("x")).otherwise(day))
    return naive(apply_type_rules(o.select("o_orderkey", text.alias("ApplicationDate")), ISO_TYPE_RULES))


@query("coerce_dates_utc", """
SELECT event_id, date_trunc('second', ts) + CASE event_type WHEN 'click' THEN to_minutes(-60)
                                                       WHEN 'view' THEN to_minutes(330)
                                                       ELSE to_minutes(0) END AS ApplicationDateTime
FROM events
""")
def coerce_dates_utc(spark, sf):
    e = t(spark, sf, "events")
    offset = (F.when(q("event_type") == "click", F.lit("+01:00"))
              .when(q("event_type") == "view", F.lit("-05:30")).otherwise(F.lit("Z")))
    text = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), offset)
    return naive(apply_type_rules(e.select("event_id", text.alias("ApplicationDateTime")), GB_TYPE_RULES))


def indicator_input(spark, sf) -> DataFrame:
    l = t(spark, sf, "lineitem")
    tf = (F.when(q("l_returnflag") == "R", F.lit("T")).when(q("l_returnflag") == "A", F.lit("F"))
          .when(q("l_linestatus") == "O", F.lit(None)).otherwise(F.lit("Z")))
    words = (F.when(q("l_returnflag") == "N", F.lit(None))
             .when(q("l_linestatus") == "O", F.lit("true")).otherwise(F.lit("false")))
    return l.select("l_orderkey", "l_linenumber", tf.alias("priority-in"), words.alias("UseIndicator"))


@query("coerce_indicators", """
SELECT l_orderkey, l_linenumber,
       CASE WHEN l_returnflag = 'R' THEN true WHEN l_returnflag = 'A' THEN false
            WHEN l_linestatus = 'O' THEN false ELSE NULL END AS "priority-in"
FROM lineitem
""")
def coerce_indicators(spark, sf):
    return apply_type_rules(indicator_input(spark, sf).drop("UseIndicator"), US_TYPE_RULES)


@query("coerce_indicator_words", """
SELECT l_orderkey, l_linenumber,
       CASE WHEN l_returnflag = 'N' THEN false WHEN l_linestatus = 'O' THEN true ELSE false END AS UseIndicator
FROM lineitem
""")
def coerce_indicator_words(spark, sf):
    return apply_type_rules(indicator_input(spark, sf).drop("priority-in"), ISO_TYPE_RULES)


@query("quality_counts", f"""
WITH {COMPACT_SQL}
SELECT 'orders' AS "table", 'filing-date' AS "column", 'us_date' AS rule,
       count(*) FILTER (WHERE s IS NOT NULL AND NOT (regexp_full_match(s, '[0-9]{{8}}')
                        AND try_strptime(s, '%Y%m%d') IS NOT NULL)) AS n_bad FROM t
UNION ALL
SELECT 'lineitem', 'priority-in', 'us_indicator',
       count(*) FILTER (WHERE l_returnflag NOT IN ('R', 'A') AND l_linestatus <> 'O') FROM lineitem
""")
def quality_counts_query(spark, sf):
    a = quality_counts(compact_date_input(spark, sf), US_TYPE_RULES, "orders")
    b = quality_counts(indicator_input(spark, sf).drop("UseIndicator"), US_TYPE_RULES, "lineitem")
    return a.unionByName(b)


# ----------------------------------------------------------- F3 F5 F6 D --
@query("english_descriptions", "SELECT DISTINCT source, text, lang FROM documents WHERE lang = 'en'")
def english_descriptions(spark, sf):
    d = t(spark, sf, "documents")
    return filter_equals(d, "lang", "en").select("source", "text", "lang").dropDuplicates()


NULLED_SUPPLIER_SQL = """
s AS (SELECT CASE WHEN s_nationkey < 3 THEN NULL ELSE s_suppkey END AS s_suppkey,
             CASE WHEN s_nationkey < 10 THEN NULL ELSE s_name END AS s_name,
             CASE WHEN s_nationkey < 5 THEN NULL ELSE s_acctbal END AS s_acctbal FROM supplier)"""


def nulled_supplier(spark, sf) -> DataFrame:
    s = t(spark, sf, "supplier")
    n = q("s_nationkey")
    return s.select(F.when(n < 3, F.lit(None)).otherwise(q("s_suppkey")).alias("s_suppkey"),
                    F.when(n < 10, F.lit(None)).otherwise(q("s_name")).alias("s_name"),
                    F.when(n < 5, F.lit(None)).otherwise(q("s_acctbal")).alias("s_acctbal"))


@query("drop_empty_rows", f"""
WITH {NULLED_SUPPLIER_SQL}
SELECT * FROM s WHERE NOT (s_name IS NULL AND s_acctbal IS NULL)
""")
def drop_empty_rows(spark, sf):
    return drop_null_rows(nulled_supplier(spark, sf), ["s_suppkey"])


@query("drop_all_null_rows", f"""
WITH {NULLED_SUPPLIER_SQL}
SELECT * FROM s WHERE NOT (s_suppkey IS NULL AND s_name IS NULL AND s_acctbal IS NULL)
""")
def drop_all_null_rows_query(spark, sf):
    return drop_all_null_rows(nulled_supplier(spark, sf))


@query("distinct_rows", "SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem")
def distinct_rows_query(spark, sf):
    return distinct_rows(t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber"))


@query("distinct_keys", "SELECT DISTINCT l_orderkey FROM lineitem")
def distinct_keys_query(spark, sf):
    return distinct_keys(t(spark, sf, "lineitem"), ["l_orderkey"])


@query("class_projection", """
SELECT DISTINCT l_orderkey AS ApplicationNumber, l_returnflag AS ClassNumber,
       l_linestatus AS ClassificationVersion FROM lineitem
""")
def class_projection(spark, sf):
    l = t(spark, sf, "lineitem").select(q("l_orderkey").alias("ApplicationNumber"),
                                        q("l_returnflag").alias("ClassNumber"),
                                        q("l_linestatus").alias("ClassificationVersion"),
                                        q("l_partkey").alias("Other"))
    return select_present(l, ["ApplicationNumber"], ["ClassNumber", "ClassificationVersion"]).dropDuplicates()


# ----------------------------------------------------------- S3 manifest --
_ANCHOR_SQL = "'<li><a href=\"([^\"]*)\">([^<]*)</a></li>'"


@query("manifest", f"""
WITH a AS (SELECT url, unnest(regexp_extract_all(html, {_ANCHOR_SQL}, 2)) AS file_name,
                  unnest(regexp_extract_all(html, {_ANCHOR_SQL}, 1)) AS target FROM pages),
b AS (SELECT CASE WHEN file_name = 'the,' THEN 'the' ELSE file_name END AS file_name, target,
             CASE WHEN url LIKE 'https:%' THEN 0 ELSE 1 END AS part_rank FROM a)
SELECT file_name, target, right(regexp_replace(target, '\\.zip$', ''), 3) AS volume, part_rank FROM b
WHERE NOT contains(file_name, 'index') AND NOT contains(file_name, 'Schema')
""")
def manifest(spark, sf):
    pages = t(spark, sf, "pages")
    links = anchors(pages, keep=("url",)).select("text", "href", "url")
    fix = {"the,": "the"}
    parts = []
    for cond in (F.col("url").startswith("https:"), ~F.col("url").startswith("https:")):
        parts.append(manifest_rows(links.filter(cond), "file_name", "target", fix))
    return sort_manifest(concat_parts(*parts))


# ----------------------------------------------------------- S8 S9 O3 F8 --
@query("version_calendar", """
WITH r AS (SELECT CAST(min(o_orderdate) AS DATE) AS s, CAST(max(o_orderdate) AS DATE) AS e FROM orders),
d AS (SELECT unnest(generate_series(CAST(s AS TIMESTAMP), CAST(e AS TIMESTAMP) - INTERVAL 1 DAY, INTERVAL 1 DAY)) AS day,
             s FROM r)
SELECT strftime(day, '%y%m%d') AS version, CAST(date_diff('day', CAST(s AS TIMESTAMP), day) + 1 AS INTEGER) AS rank
FROM d
""")
def version_calendar(spark, sf):
    o = t(spark, sf, "orders")
    bounds = o.agg(F.min("o_orderdate").cast("date").alias("s"), F.max("o_orderdate").cast("date").alias("e"))
    return bounds.select(F.posexplode(daily_versions(F.col("s"), F.col("e"))).alias("p", "version")) \
        .select("version", (F.col("p") + 1).alias("rank"))


@query("historical_versions", """
SELECT lpad(CAST(i AS VARCHAR), 2, '0') AS version, CAST(i AS INTEGER) AS rank
FROM (SELECT unnest(generate_series(1, (SELECT count(DISTINCT year(o_orderdate)) FROM orders))) AS i)
""")
def historical_versions_query(spark, sf):
    """The historical series ``01``..``n``, n = the years present in orders."""
    n = t(spark, sf, "orders").agg(F.countDistinct(F.year("o_orderdate")).cast("int").alias("n"))
    return n.select(F.posexplode(historical_versions(F.col("n"))).alias("p", "version")) \
        .select("version", (F.col("p") + 1).alias("rank"))


def order_day_versions(spark, sf) -> DataFrame:
    """S9 listing: one version per order day; days up to 1996 form the
    'Full' stage, later days 'Differential'; order (stage, year, name)."""
    o = t(spark, sf, "orders")
    year = F.year("o_orderdate")
    listing = o.select(F.date_format("o_orderdate", "yyMMdd").alias("version"),
                       F.when(year <= 1996, F.lit("Full")).otherwise(F.lit("Differential")).alias("stage"),
                       F.when(year <= 1996, 0).otherwise(1).alias("stage_rank"),
                       year.alias("year")).distinct()
    return order_versions(listing, ["stage_rank", "year", "version"])


ORDER_DAY_VERSIONS_SQL = """
v AS (SELECT DISTINCT strftime(o_orderdate, '%y%m%d') AS version,
             CASE WHEN year(o_orderdate) <= 1996 THEN 'Full' ELSE 'Differential' END AS stage,
             CASE WHEN year(o_orderdate) <= 1996 THEN 0 ELSE 1 END AS stage_rank,
             CAST(year(o_orderdate) AS INTEGER) AS year FROM orders),
r AS (SELECT version, stage, year,
             CAST(row_number() OVER (ORDER BY stage_rank, year, version) AS INTEGER) AS rank FROM v)"""


@query("version_order", f"WITH {ORDER_DAY_VERSIONS_SQL} SELECT version, stage, year, rank FROM r")
def version_order(spark, sf):
    return order_day_versions(spark, sf).select("version", "stage", "year", "rank")


@query("next_version", f"""
WITH {ORDER_DAY_VERSIONS_SQL}
SELECT 'xx' AS office, 'default' AS "schema", version, rank FROM r WHERE stage = 'Differential' ORDER BY rank LIMIT 1
""")
def next_version_query(spark, sf):
    v = order_day_versions(spark, sf).select(F.lit("xx").alias("office"), F.lit("default").alias("schema"),
                                            "version", "rank", "stage")
    ledger = v.filter(F.col("stage") == "Full").drop("stage")
    return next_version_of(v.drop("stage"), ledger)


@query("unlanded_versions", """
WITH r AS (SELECT CAST(min(o_orderdate) AS TIMESTAMP) AS s, CAST(max(o_orderdate) AS TIMESTAMP) AS e FROM orders),
d AS (SELECT strftime(unnest(generate_series(s, e - INTERVAL 1 DAY, INTERVAL 1 DAY)), '%y%m%d') AS version FROM r),
l AS (SELECT DISTINCT strftime(o_orderdate, '%y%m%d') AS version FROM orders)
SELECT version FROM d WHERE version NOT IN (SELECT version FROM l)
""")
def unlanded_versions(spark, sf):
    o = t(spark, sf, "orders")
    bounds = o.agg(F.min("o_orderdate").cast("date").alias("s"), F.max("o_orderdate").cast("date").alias("e"))
    expected = bounds.select(F.explode(daily_versions(F.col("s"), F.col("e"))).alias("version"))
    landed = o.select(F.date_format("o_orderdate", "yyMMdd").alias("version"))
    return unlanded(expected, landed, ["version"])


# ----------------------------------------------------------- S11 ledger ---
ORDERS_LEDGER_SQL = """
v AS (SELECT DISTINCT o_orderpriority AS office, o_orderstatus AS "schema", strftime(o_orderdate, '%y%m') AS version,
             CAST(year(o_orderdate) * 100 + month(o_orderdate) AS INTEGER) AS rank FROM orders)"""


def orders_ledger(spark, sf) -> DataFrame:
    o = t(spark, sf, "orders")
    return o.select(q("o_orderpriority").alias("office"), q("o_orderstatus").alias("schema"),
                    F.date_format("o_orderdate", "yyMM").alias("version"),
                    (F.year("o_orderdate") * 100 + F.month("o_orderdate")).cast("int").alias("rank")).distinct()


@query("ledger_latest", f"""
WITH {ORDERS_LEDGER_SQL}
SELECT office, "schema", arg_max(version, rank) AS latest, max(rank) AS latest_rank FROM v GROUP BY office, "schema"
""")
def ledger_latest(spark, sf):
    return latest(orders_ledger(spark, sf))


@query("pending_versions", """
WITH v AS (SELECT DISTINCT o_orderpriority AS office, strftime(o_orderdate, '%y%m') AS version,
                  CAST(year(o_orderdate) * 100 + month(o_orderdate) AS INTEGER) AS rank FROM orders),
led AS (SELECT o_orderpriority AS office, max(CAST(year(o_orderdate) * 100 + month(o_orderdate) AS INTEGER)) AS m
        FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 400000 GROUP BY 1)
SELECT v.office, v.version, v.rank FROM v LEFT JOIN led ON v.office = led.office
WHERE led.m IS NULL OR v.rank > led.m
""")
def pending_versions(spark, sf):
    o = t(spark, sf, "orders")
    rank = (F.year("o_orderdate") * 100 + F.month("o_orderdate")).cast("int").alias("rank")
    versions = o.select(q("o_orderpriority").alias("office"), F.date_format("o_orderdate", "yyMM").alias("version"),
                        rank).distinct()
    ledger = (o.filter((q("o_orderstatus") == "F") & (q("o_totalprice") > 400000))
              .select(q("o_orderpriority").alias("office"), F.date_format("o_orderdate", "yyMM").alias("version"),
                      rank))
    return pending(versions, ledger, ["office"])


# ----------------------------------------------------------- L2 L4 --------
@query("phased_merge", """
SELECT s_suppkey, s_name, s_nationkey,
       s_acctbal + CASE WHEN s_nationkey BETWEEN 3 AND 7 THEN 4 WHEN s_nationkey < 3 THEN 3
                        WHEN s_nationkey < 10 THEN 2 ELSE 1 END AS s_acctbal,
       CASE WHEN s_nationkey < 10 AND NOT s_nationkey BETWEEN 8 AND 9 THEN 'rollup'
            ELSE 'full' END AS phase,
       CASE WHEN s_nationkey BETWEEN 3 AND 7 THEN 'b' WHEN s_nationkey < 3 THEN 'a'
            WHEN s_nationkey < 10 THEN 'c' ELSE 'b' END AS version
FROM supplier
""")
def phased_merge(spark, sf):
    s = t(spark, sf, "supplier")
    n = q("s_nationkey")

    def version(phase, name, cond, bump):
        return (s.filter(cond).withColumn("s_acctbal", q("s_acctbal") + bump)
                .withColumn("phase", F.lit(phase)).withColumn("version", F.lit(name)))
    # names sort the other way round from phases: order is (phase, name)
    landed = {("full", "b"): version("full", "b", F.lit(True), 1),
              ("full", "c"): version("full", "c", n < 10, 2),
              ("rollup", "a"): version("rollup", "a", n < 5, 3),
              ("rollup", "b"): version("rollup", "b", n.between(3, 7), 4)}
    phase_rank = {"full": 0, "rollup": 1}
    order = sorted(landed, key=lambda k: (phase_rank[k[0]], k[1]))
    versions = [TableVersion(i, landed[k]) for i, k in enumerate(order)]
    return fold_merge(None, versions, ["s_suppkey"])


# ----------------------------------------------------------- S4 W1-W5 -----
@query("parquet_roundtrip", f"SELECT {LINEITEM_COLS} FROM lineitem")
def parquet_roundtrip(spark, sf):
    path = work_dir(spark, "roundtrip")
    save_table(t(spark, sf, "lineitem"), path)
    return spark.read.parquet(path)


@query("compact_single_file", "SELECT * FROM orders")
def compact_single_file(spark, sf):
    """The published form of a stored table (the number of files is tested apart)."""
    src, dst = work_dir(spark, "compact-src"), work_dir(spark, "compact")
    save_table(t(spark, sf, "orders"), src, rebalance=False)
    compact_files(spark, src, dst)
    return spark.read.parquet(dst)


@query("int96_roundtrip", "SELECT * FROM events")
def int96_roundtrip(spark, sf):
    path = work_dir(spark, "int96")
    compact_table(t(spark, sf, "events"), path, int96=True)
    return naive(spark.read.parquet(path))


@query("catalog_columns", f"""
SELECT DISTINCT 'testdata' AS folder, table_name AS file, CAST(ordinal_position AS INTEGER) AS position,
       column_name AS "column"
FROM information_schema.columns WHERE table_name IN ({", ".join(f"'{x}'" for x in TABLES)})
""")
def catalog_columns(spark, sf):
    return catalog(spark, {"testdata": {name: f"{sf.rstrip('/')}/{name}.parquet" for name in TABLES}})


# Columns of the driver tables and the kind of their bounds.
STATISTICS = {
    "customer": {"c_custkey": "long", "c_name": "", "c_nationkey": "long", "c_acctbal": "double", "c_mktsegment": ""},
    "events": {"event_id": "long", "ts": "", "user_id": "long", "event_type": "", "value": "double", "props": ""},
    "lineitem": {"l_orderkey": "long", "l_partkey": "long", "l_suppkey": "long", "l_linenumber": "long", "l_quantity": "double",
                 "l_extendedprice": "double", "l_discount": "double", "l_tax": "double", "l_returnflag": "", "l_linestatus": "",
                 "l_shipdate": ""},
    "orders": {"o_orderkey": "long", "o_custkey": "long", "o_orderstatus": "", "o_totalprice": "double", "o_orderdate": "",
               "o_orderpriority": ""},
    "part": {"p_partkey": "long", "p_name": "", "p_brand": "", "p_type": "", "p_size": "long", "p_retailprice": "double"},
}


def _statistics_sql(table: str, column: str, kind: str) -> str:
    # zero has no sign in a bound: DuckDB too reads -0.0 from a footer
    bounds = ", ".join(f"{f'CAST(CASE WHEN {fn}({column}) = 0 THEN 0 ELSE {fn}({column}) END AS {sql})' if kind == k else f'CAST(NULL AS {sql})'} AS {end}_{k}"
                       for k, sql in (("long", "BIGINT"), ("double", "DOUBLE"), ("date", "DATE"))
                       for end, fn in (("low", "min"), ("high", "max")))
    return (f"""SELECT '{table}' AS file, '{column}' AS "column", count(*) AS n_rows, count(*) - count({column}) AS n_nulls, """
            f"{bounds} FROM {table}")


@query("catalog_statistics", " UNION ALL ".join(
    _statistics_sql(table, column, kind) for table, columns in STATISTICS.items() for column, kind in columns.items()))
def catalog_statistics(spark, sf):
    """Rows, nulls and bounds of every column, from the footers."""
    return column_statistics(spark, {name: f"{sf.rstrip('/')}/{name}.parquet" for name in STATISTICS})


# ----------------------------------------------------------- L5 -----------
@query("snapshot_commit", """
SELECT c_custkey, c_name, c_nationkey,
       CASE WHEN c_mktsegment = 'BUILDING' THEN c_acctbal + 1 ELSE c_acctbal END AS c_acctbal, c_mktsegment
FROM customer
""")
def snapshot_commit(spark, sf):
    c = t(spark, sf, "customer")
    store = SnapshotStore(spark, work_dir(spark, "snapshots"), "xx")
    keys = ["c_custkey"]
    store.apply_version("v1", 1, {"customer": c}, keys)
    building = c.filter(q("c_mktsegment") == "BUILDING").withColumn("c_acctbal", q("c_acctbal") + 1)
    store.apply_version("v2", 2, {"customer": building}, keys)
    auto = c.filter(q("c_mktsegment") == "AUTOMOBILE").withColumn("c_acctbal", q("c_acctbal") + 2)
    try:
        store.apply_version("v3", 3, {"customer": auto}, keys, fail_before_commit=True)
    except RuntimeError:
        pass  # v3 wrote its snapshot but never committed: invisible
    return store.current("customer")


@query("conflicting_writers", """
SELECT c_custkey, c_name, CASE WHEN c_mktsegment = 'BUILDING' THEN c_acctbal + 1 ELSE c_acctbal END AS c_acctbal, 2 AS refused FROM customer
""")
def conflicting_writers(spark, sf):
    """Two writers of one rank: the one that comes second is refused before it writes a folder, and so is one whose
    rank was committed by a writer that died before its ledger rows, which the next writer adds."""
    c = t(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")
    root, keys, refused = work_dir(spark, "conflict"), ["c_custkey"], 0
    a, b = SnapshotStore(spark, root, "xx"), SnapshotStore(spark, root, "xx")
    a.apply_version("v1", 1, {"customer": c}, keys)
    building = c.filter(q("c_mktsegment") == "BUILDING").withColumn("c_acctbal", q("c_acctbal") + 1)
    with a.claimed(2) as held:
        path = a.write_snapshot("customer", 2, update_table(a.current("customer"), building, keys))
        try:
            b.apply_version("v2", 2, {"customer": c.limit(0)}, keys)
        except claims.Conflict:
            refused += 1
        claims.commit(spark, held[0], [("v2", 2, {"customer": path})])  # and dies here
    try:
        b.apply_version("v2", 2, {"customer": c.limit(0)}, keys)
    except ValueError:
        refused += 1
    return b.current("customer").select(*c.columns[:3]).withColumn("refused", F.lit(refused))


@query("cascade_merge", """
SELECT o_custkey AS c_custkey, o_orderkey FROM orders
WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')
""")
def cascade_merge(spark, sf):
    """R6 option: v2 re-sends the BUILDING customers without their orders
    table; with cascade the re-sent records lose their old orders too."""
    c, o = t(spark, sf, "customer"), t(spark, sf, "orders")
    keys = ["c_custkey"]
    store = SnapshotStore(spark, work_dir(spark, "cascade"), "xx")
    store.apply_version("v1", 1, {"customer": c.select("c_custkey", "c_name"),
                                  "orders": o.select(q("o_custkey").alias("c_custkey"), "o_orderkey")}, keys)
    resent = c.filter(q("c_mktsegment") == "BUILDING").select("c_custkey", F.upper("c_name").alias("c_name"))
    store.apply_version("v2", 2, {"customer": resent}, keys, cascade=True)
    return store.current("orders")


@query("merge_on_read_commit", """
SELECT c_custkey, c_name, c_nationkey,
       CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN c_acctbal + 2
            WHEN c_mktsegment = 'BUILDING' THEN c_acctbal + 1 ELSE c_acctbal END AS c_acctbal,
       c_mktsegment
FROM customer WHERE c_mktsegment = 'AUTOMOBILE' OR c_nationkey NOT IN (1, 2)
""")
def merge_on_read_commit(spark, sf):
    """Deltas only on write, single-pass merge on read, compaction every 2."""
    c = t(spark, sf, "customer")
    keys = ["c_custkey"]
    store = SnapshotStore(spark, work_dir(spark, "mor"), "xx", mode="merge_on_read", keys=keys,
                          compact_every=2)
    store.apply_version("v1", 1, {"customer": c}, keys)
    building = c.filter(q("c_mktsegment") == "BUILDING").withColumn("c_acctbal", q("c_acctbal") + 1)
    store.apply_version("v2", 2, {"customer": building}, keys)          # compacts (2 deltas)
    auto = c.filter(q("c_mktsegment") == "AUTOMOBILE").withColumn("c_acctbal", q("c_acctbal") + 2)
    dels = c.filter(q("c_nationkey").isin(1, 2)).select("c_custkey")
    store.apply_version("v3", 3, {"customer": auto}, keys, dels)        # delete + re-send
    try:
        store.apply_version("v4", 4, {"customer": c.filter(F.lit(False))}, keys, c.select("c_custkey"),
                            fail_before_commit=True)
    except RuntimeError:
        pass  # v4 never committed: its delete-everything is invisible
    return store.current("customer")


@query("stream_landed_versions", """
SELECT c_custkey, c_name, c_nationkey,
       CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN c_acctbal + 2
            WHEN c_mktsegment = 'BUILDING' THEN c_acctbal + 1 ELSE c_acctbal END AS c_acctbal,
       c_mktsegment
FROM customer
""")
def stream_landed_versions(spark, sf):
    """Structured Streaming front: versions land out of order (v3 before v2);
    each availableNow run applies only the ranks that continue the ledger."""
    c = t(spark, sf, "customer")
    spec = OfficeSpec(office="xx", row_tag="customer", keys=("c_custkey",), separate=lambda df: {})
    landing, ckpt = work_dir(spark, "stream-landing"), work_dir(spark, "stream-ckpt")
    store = SnapshotStore(spark, work_dir(spark, "stream-store"), "xx")

    def land(version, rank, df):
        df.write.parquet(table_folder(landing, "xx", version, "customer"))
        mark_landed(spark, landing, "xx", version, rank)
    land("v1", 1, c)
    land("v3", 3, c.filter(q("c_mktsegment") == "AUTOMOBILE").withColumn("c_acctbal", q("c_acctbal") + 2))
    start_stream(spark, spec, landing, store, ckpt).awaitTermination()  # applies v1; v3 waits
    land("v2", 2, c.filter(q("c_mktsegment") == "BUILDING").withColumn("c_acctbal", q("c_acctbal") + 1))
    start_stream(spark, spec, landing, store, ckpt).awaitTermination()  # applies v2 then v3
    return store.current("customer")


# ----------------------------------------------------------- S6 F7 K3 -----
@query("landing_inventory", """
SELECT DISTINCT 'o' || substr(o_orderpriority, 1, 1) AS office, strftime(o_orderdate, '%Y') AS version,
       'orders' AS "table" FROM orders
""")
def landing_inventory(spark, sf):
    o = t(spark, sf, "orders")
    root = work_dir(spark, "landing")
    landed = o.select("*", F.concat(F.lit("o"), F.substring("o_orderpriority", 1, 1)).alias("office"),
                      F.date_format("o_orderdate", "yyyy").alias("version"))
    (landed.withColumn("table", F.lit("orders"))
     .write.partitionBy("office", "version", "table").parquet(root))
    (landed.filter(q("o_orderstatus") == "F").select("o_orderkey", "office", "version")
     .withColumn("table", F.lit("delete"))
     .write.mode("append").partitionBy("office", "version", "table").parquet(root))
    return landed_tables(inventory(spark, root))


# ----------------------------------------------------------- S2 -----------
ORDER_FIELDS = ("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")


def _zip_writer(root: str, tag: str):
    """Each task packs its partition into ``part-<partition>.zip``.  The file
    is written under an attempt-specific name and renamed into place, so a
    retried task replaces, never duplicates, its archive."""
    import os
    import zipfile

    import pandas as pd
    from pyspark import TaskContext

    def write(batches):
        ctx = TaskContext.get()
        path = f"{root}/part-{ctx.partitionId():05d}.zip"
        local = path.removeprefix("file:")
        tmp = f"{os.path.dirname(local)}/.attempt-{ctx.partitionId():05d}-{ctx.attemptNumber()}.tmp"
        os.makedirs(os.path.dirname(local), exist_ok=True)
        n = 0
        with zipfile.ZipFile(tmp, "w", compression=zipfile.ZIP_DEFLATED) as zf:
            with zf.open("records.xml", "w") as fh:
                fh.write(f"<?xml version=\"1.0\"?>\n<{tag}s>\n".encode())
                for pdf in batches:
                    for rec in pdf["xml"]:
                        fh.write(rec.encode("utf-8"))
                        fh.write(b"\n")
                        n += 1
                fh.write(f"</{tag}s>\n".encode())
        os.replace(tmp, local)
        yield pd.DataFrame({"archive": [path], "records": [n]})
    return write


@query("archive_expand", "SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority FROM orders")
def archive_expand(spark, sf):
    o = t(spark, sf, "orders")
    root = work_dir(spark, "archives")
    xml = o.select(F.to_xml(F.struct(*[q(c).cast("string").alias(c) for c in ORDER_FIELDS]),
                            {"rowTag": "order"}).alias("xml"))
    # each task packs its partition into one archive on shared storage
    xml.mapInPandas(_zip_writer(root, "order"), "archive string, records long").count()
    schema = T.StructType([T.StructField(c, T.StringType()) for c in ORDER_FIELDS])
    recs = expand_archives(spark, root, "order")
    parsed = parse_records(recs, "record", schema)
    return parsed.select(q("o_orderkey").cast("bigint").alias("o_orderkey"),
                         q("o_custkey").cast("bigint").alias("o_custkey"), "o_orderstatus", "o_orderpriority")


@query("archive_member_spans", "SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority FROM orders")
def archive_member_spans(spark, sf):
    """Members far larger than a span: each is indexed once and read by several tasks from its access points."""
    o = t(spark, sf, "orders")
    root = work_dir(spark, "archive-spans")
    xml = o.select(F.to_xml(F.struct(*[q(c).cast("string").alias(c) for c in ORDER_FIELDS]),
                            {"rowTag": "order"}).alias("xml"))
    xml.mapInPandas(_zip_writer(root, "order"), "archive string, records long").count()
    schema = T.StructType([T.StructField(c, T.StringType()) for c in ORDER_FIELDS])
    parsed = parse_records(expand_archives(spark, root, "order", span=1 << 16), "record", schema)
    return parsed.select(q("o_orderkey").cast("bigint").alias("o_orderkey"),
                         q("o_custkey").cast("bigint").alias("o_custkey"), "o_orderstatus", "o_orderpriority")


# ----------------------------------------------------------- S10 ----------
CODE_COLUMNS = (("orders", "o_orderstatus"), ("orders", "o_orderpriority"), ("lineitem", "l_returnflag"),
                ("lineitem", "l_linestatus"), ("customer", "c_mktsegment"), ("events", "event_type"))


@query("code_seed", " UNION ALL ".join(
    f"SELECT '{tb}' AS table_name, '{col}' AS column_name, count(DISTINCT {col}) AS n_codes FROM {tb}"
    for tb, col in CODE_COLUMNS))
def code_seed(spark, sf):
    parts = [t(spark, sf, tb).select(F.lit(tb).alias("table_name"), F.lit(col).alias("column_name"),
                                     q(col).alias("code")).distinct() for tb, col in CODE_COLUMNS]
    seed = align_union(*parts).withColumn("description",
                                          F.concat_ws(" = ", F.col("column_name"), F.col("code")))
    path = work_dir(spark, "codes")
    write_codes(seed, path)
    return code_counts(read_codes(spark, path))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: v[0] for k, v in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    return {k: v[1] for k, v in REGISTRY.items() if v[1] is not None}
