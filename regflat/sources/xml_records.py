"""XML record scan (S1) on Spark's built-in XML source.

Every leaf is read as a string (``inferSchema=false``); the reader infers
only the nesting.  Attributes keep an ``@`` prefix and element text lands
in ``#text``, which the office name rules strip later.  Namespace prefixes
are kept (``ignoreNamespace=false``) because the name rules are written
for them; ``rowTag`` must then carry the prefix as well.

At scale, pass the schema stored beside the ledger instead of inferring:
inference is a full extra pass over the input.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from regflat.sources import xml_lexer
from regflat.sources.archive import ascii_safe, declared_encoding, split_records
from regflat.sources.stores import open_file, open_stream

XML_OPTIONS = {
    "attributePrefix": "@",
    "valueTag": "#text",
    "inferSchema": "false",
    "ignoreNamespace": "false",
    "mode": "PERMISSIVE",
}


def read_xml(spark: SparkSession, paths: str | Sequence[str], row_tag: str,
             schema: T.StructType | None = None, **options: str) -> DataFrame:
    """One row per ``row_tag`` element, nested cells."""
    reader = spark.read.format("xml").options(**XML_OPTIONS).option("rowTag", row_tag)
    reader = reader.options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(paths if isinstance(paths, str) else list(paths))


class BadRecords(ValueError):
    """Records that do not parse."""


PIECE = 1 << 20  # bytes lexed at once
LEAST = 1 << 12  # bytes of the first read where a little may do
MOST = 64 << 20  # bytes of a range, at most
PACKED = (".gz", ".bz2", ".zst", ".lz4", ".snappy")
UNPACKED = 16    # bytes of text that a compressed byte is counted as when work is dealt


def _pieces(file, size: int, lo: int, hi: int, first: int = PIECE):
    """Bytes ``lo`` .. ``hi`` of a file, both moved on to the next ``<``, as pieces cut before a ``<``; (place, piece).

    Pieces begin with ``first`` bytes and double up to ``PIECE``: who needs the end of one record reads little more."""
    def aligned(at: int) -> int:
        step = LEAST
        while 0 < at < size:
            data = file.read_at(min(step, size - at), at)
            i = data.find(b"<")
            if i >= 0:
                return at + i
            at += len(data)
            step = min(2 * step, 1 << 16)
        return min(at, size)

    at, end, step = aligned(lo), aligned(hi), first
    while at < end:
        stop = min(end, aligned(min(end, at + step)))
        yield at, file.read_at(stop - at, at)
        at, step = stop, min(2 * step, PIECE)


def _encoding(path: str, given: str | None) -> str | None:
    """The file's encoding, None where its bytes cannot be lexed in ranges."""
    if path.endswith(PACKED):
        return None
    with open_file(path) as file:
        name = given or declared_encoding(file.read(512))
    return name if ascii_safe(name) else None


def _range_maps(tag: str, given: str | None):
    """First pass: what each range does to every state that it may begin in."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding_of = lru_cache(maxsize=64)(_encoding)  # a task may hold many ranges of a file
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                now = list(xml_lexer.STATES)
                if encoding_of(r["path"], given) is not None:
                    with open_file(r["path"]) as file:
                        for _, piece in _pieces(file, r["size"], r["lo"], r["hi"]):
                            does = xml_lexer.piece_map(tag, piece)
                            now = [does[s] for s in now]
                out.append(bytes(now))
            yield pa.record_batch({"path": batch.column("path"), "lo": batch.column("lo"), "does": pa.array(out, pa.binary())})
    return run


def _chained(table: pa.Table) -> pa.Table:
    """The state before each range of one file: nine bytes a range."""
    table = table.sort_by("lo")
    states = xml_lexer.chain(table.column("does").to_pylist())
    return table.drop_columns(["does"]).append_column("state", pa.array(states, pa.int32()))


def _range_records(tag: str, given: str | None):
    """Second pass: the records that begin in each range, read on to their end."""
    def of_range(r: dict, encoding: str) -> Iterator[str]:
        records = xml_lexer.Records(tag, r["state"])
        with open_file(r["path"]) as file:
            for _, piece in _pieces(file, r["size"], r["lo"], r["hi"]):
                yield from (x.decode(encoding) for x in records.feed(piece))
            if records.parts is not None:
                for _, piece in _pieces(file, r["size"], r["hi"], r["size"], LEAST):
                    yield from (x.decode(encoding) for x in records.feed(piece, only_open=True))
                    if records.parts is None:
                        return
                # cut off by the end of the file: closed, so that parsing finds what is not whole in it
                yield b"".join(records.parts).decode(encoding, "replace") + f"</{tag}>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding_of = lru_cache(maxsize=64)(_encoding)
        for batch in batches:
            for r in batch.to_pylist():
                encoding = encoding_of(r["path"], given)
                if encoding is not None:
                    found = of_range(r, encoding)
                elif r["lo"] == 0:  # one stream
                    found = split_records(open_stream(r["path"]), tag, given, keep_unfinished=True)
                else:
                    continue
                held, size = [], 0
                for x in found:
                    held.append(x)
                    size += len(x)
                    if size >= 4 * PIECE:
                        yield pa.record_batch({"record": pa.array(held, pa.string())})
                        held, size = [], 0
                if held:
                    yield pa.record_batch({"record": pa.array(held, pa.string())})
    return run


def record_strings(spark: SparkSession, paths: str | Sequence[str], row_tag: str, encoding: str | None = None,
                   range_bytes: int | None = None, ranges: DataFrame | None = None) -> DataFrame:
    """One row ``(record)`` per ``row_tag`` element, as text, from byte ranges of any file.

    Ranges (``spark.sql.files.maxPartitionBytes`` unless given) begin anywhere, inside a comment, a CDATA section or a
    quoted value too.  Files of several ranges are read twice: the first pass lexes each range from every state that it
    may begin in, the maps are chained per file, and the second pass takes the records that begin in each range, read on
    to their end.  The records are those that :func:`split_records` finds in the whole file, ``<tag a="1"/>`` included.
    A record cut off by the end of the file gets its end tag and fails to parse if anything in it is not whole.  Files
    are read in the encoding that they declare (or the given one); compressed ones and UTF-16 are one range.
    Elements of the row tag do not nest.

    Tasks are dealt by bytes, however short the ranges are.  The only figures that Spark measures below the records are
    those of the ranges, a few bytes for each, so it would take any join of records for a small one and broadcast it:
    a hint keeps such joins sort-merge joins (a broadcast hint on the other side goes before it).

    Who reads the records more than once passes ``ranges``, those of :func:`record_ranges`, kept.
    """
    if ranges is None:
        ranges = record_ranges(spark, paths, row_tag, encoding, range_bytes)
    return ranges.mapInArrow(_range_records(row_tag, encoding), "record string").hint("merge")


def record_ranges(spark: SparkSession, paths: str | Sequence[str], row_tag: str, encoding: str | None = None,
                  range_bytes: int | None = None) -> DataFrame:
    """The byte ranges of files and the state before each, dealt to tasks: a few bytes a range."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "false") \
        .load(paths if isinstance(paths, str) else list(paths)).select("path", F.col("length").alias("size")).where("size > 0")
    packed = F.col("path").rlike(f"({'|'.join(map(re.escape, PACKED))})$")
    told = files.agg(F.sum(F.col("size") * F.when(packed, UNPACKED).otherwise(1)), F.max("size"), F.count(F.lit(1))).first()
    said = spark.conf.get("spark.sql.files.maxPartitionBytes")
    task_bytes = min(MOST, spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(said))
    range_bytes = range_bytes or task_bytes
    ranges = files.withColumn("lo", F.explode(F.sequence(F.lit(0).cast("long"), F.col("size") - 1, F.lit(range_bytes).cast("long")))) \
        .withColumn("hi", F.least(F.col("lo") + range_bytes, F.col("size")))
    # at least as many as can run at once, where there are as many files
    tasks = max(1, -(-(told[0] or 0) // max(range_bytes, task_bytes)), min(told[2], spark.sparkContext.defaultParallelism))
    if (told[1] or 0) > range_bytes:
        several = ranges.where(F.col("size") > range_bytes).repartition(tasks)
        state = several.mapInArrow(_range_maps(row_tag, encoding), "path string, lo long, does binary") \
            .groupBy("path").applyInArrow(_chained, "path string, lo long, state int")
        ranges = ranges.join(state, ["path", "lo"], "left")
    else:
        ranges = ranges.withColumn("state", F.lit(None).cast("int"))
    ranges = ranges.select("path", "size", "lo", "hi", F.coalesce("state", F.lit(xml_lexer.OUT)).alias("state"))
    return ranges.repartition(tasks)


def parse_strings(records: DataFrame, schema: T.StructType, column: str = "record", on_bad: str = "raise",
                  quarantine: str | None = None) -> DataFrame:
    """Record strings -> nested rows with a given schema.

    A record that does not parse raises (``on_bad="raise"``, when the row is
    read), or goes to the table ``quarantine`` and is left out
    (``on_bad="quarantine"``); it never takes its neighbours with it.
    """
    bad = "_corrupt_record"
    options = {k: v for k, v in XML_OPTIONS.items() if k != "inferSchema"} | {"columnNameOfCorruptRecord": bad}
    full = T.StructType([*schema.fields, T.StructField(bad, T.StringType())])
    # a generator: the check below stays behind it, so a record is parsed once
    parsed = records.select(F.inline(F.array(F.from_xml(F.col(column), full, options))))
    if on_bad == "raise":
        # a filter, so that no projection and no count goes without it
        wrong = F.raise_error(F.concat(F.lit("BadRecords: "), F.substring(bad, 1, 200))).cast("boolean")
        return parsed.where(F.when(F.col(bad).isNotNull(), wrong).otherwise(True)).drop(bad)
    if quarantine is not None:
        parsed.where(F.col(bad).isNotNull()).select(F.col(bad).alias("record")).write.mode("overwrite").parquet(quarantine)
    return parsed.where(F.col(bad).isNull()).drop(bad)


def read_records(spark: SparkSession, paths: str | Sequence[str], row_tag: str, schema: T.StructType | None = None,
                 on_bad: str = "raise", quarantine: str | None = None, ranges: DataFrame | None = None) -> DataFrame:
    """S1 as the pipeline does it: splittable record strings, parsed with the stored (or inferred) schema."""
    if schema is None:
        schema = record_schema(spark, paths, row_tag, ranges)
    if not schema.fields:
        return spark.createDataFrame([], T.StructType([]))
    return parse_strings(record_strings(spark, paths, row_tag, ranges=ranges), schema, on_bad=on_bad, quarantine=quarantine)


def write_xml(df: DataFrame, path: str, row_tag: str, root_tag: str, mode: str = "error") -> None:
    """Write nested rows as XML records (used to land test versions)."""
    (df.write.format("xml").options(**XML_OPTIONS).option("rowTag", row_tag)
     .option("rootTag", root_tag).mode(mode).save(path))


def parse_records(df: DataFrame, column: str, schema: T.StructType,
                  keep: Sequence[str] = ()) -> DataFrame:
    """S1 on record strings (e.g. from archives): ``from_xml`` with a schema."""
    opts = {k: v for k, v in XML_OPTIONS.items() if k != "inferSchema"}
    parsed = F.from_xml(F.col(column), schema, opts).alias("_rec")
    return df.select(*keep, parsed).select(*keep, "_rec.*")


def record_schema(spark: SparkSession, landed_path: str | Sequence[str], row_tag: str, ranges: DataFrame | None = None) -> T.StructType:
    """Infer the nesting of one landed version (strings at the leaves) from its record strings.

    A full, split pass over the input: do it once, store the result beside the
    ledger and pass it to :func:`read_records` from then on."""
    strings = record_strings(spark, landed_path, row_tag, ranges=ranges)
    reader = spark.read.options(**XML_OPTIONS).option("rowTag", row_tag)._jreader
    encoder = spark._jvm.org.apache.spark.sql.Encoders.STRING()
    found = DataFrame(reader.xml(getattr(strings._jdf, "as")(encoder)), spark).schema
    return T.StructType([f for f in found.fields if f.name != "_corrupt_record"])


def as_text_schema(dtype: T.DataType) -> T.DataType:
    """The XML reading schema of a nested type: same nesting, string leaves."""
    if isinstance(dtype, T.StructType):
        return T.StructType([T.StructField(f.name, as_text_schema(f.dataType), True) for f in dtype.fields])
    if isinstance(dtype, T.ArrayType):
        return T.ArrayType(as_text_schema(dtype.elementType), True)
    return T.StringType()


def schema_to_json(schema: T.StructType) -> str:
    """Serialise a stored record schema (kept beside the ledger)."""
    return schema.json()


def schema_from_json(text: str) -> T.StructType:
    return T.StructType.fromJson(__import__("json").loads(text))


def store_schema(spark: SparkSession, path: str, schema: T.StructType) -> None:
    """Keep a version's reading schema beside the landing (one small text file,
    written through Spark so any shared storage works)."""
    spark.createDataFrame([(schema_to_json(schema),)], "s string").coalesce(1) \
        .write.mode("overwrite").text(path)


def load_schema(spark: SparkSession, path: str) -> T.StructType | None:
    try:
        row = spark.read.text(path).first()
    except Exception as exc:  # nothing stored yet
        if "PATH_NOT_FOUND" in str(exc) or "does not exist" in str(exc):
            return None
        raise
    return None if row is None else schema_from_json(row[0])
