"""Zip archives of XML.

The built-in XML reader does not open ``.zip``.  We list archives with the
``binaryFile`` source selecting only ``path`` (the content column is
pruned, so no archive is loaded into a row) and open them inside tasks with
random access, on any store that Arrow reads.  Members are independent, so
each is read by its own task; a member of more than a span of compressed data
is indexed once (``deflate_index``) and then read by as many tasks as it has
spans: like byte ranges of plain files, spans are lexed from every state that
they may begin in, the maps are chained, and each record is taken by the span
that it begins in.
"""

from __future__ import annotations

import codecs
import io
import re
import zipfile
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from regflat.session import work_dir
from regflat.sources import deflate_index, xml_lexer
from regflat.sources.stores import open_file

RECORD_SCHEMA = "archive string, member string, record string"
_CHUNK = 1 << 20


class UnfinishedRecord(ValueError):
    """A member ends inside a record."""


_DECLARED = re.compile(rb"""^\s*<\?xml[^>]*?encoding\s*=\s*["']([A-Za-z0-9._-]+)["']""")


def declared_encoding(head: bytes) -> str:
    """The encoding that a document names in its byte-order mark or XML declaration; UTF-8 if none."""
    for mark, name in ((b"\xef\xbb\xbf", "utf-8-sig"), (b"\xff\xfe", "utf-16"), (b"\xfe\xff", "utf-16")):
        if head.startswith(mark):
            return name
    m = _DECLARED.match(head)
    return m.group(1).decode() if m else "utf-8"


def split_records(stream: io.BufferedIOBase, tag: str, encoding: str | None = None, keep_unfinished: bool = False) -> Iterator[str]:
    """Yield each ``<tag ...>...</tag>`` (or ``<tag/>``) element of a stream.

    Works on bounded chunks, so a member of any size streams through.  Tags
    inside comments and CDATA sections do not count (see ``xml_lexer``).  Text
    that does not decode, and a record that the stream ends in, raise (with
    ``keep_unfinished`` the latter is closed and kept).
    """
    head = stream.read(512)
    encoding = encoding or declared_encoding(head)
    # bytes are lexed in UTF-8
    decode = codecs.getincrementaldecoder(encoding)(errors="strict").decode
    records = xml_lexer.Records(tag)

    def chunks() -> Iterator[bytes]:
        chunk = head
        while chunk:
            yield decode(chunk).encode()
            chunk = stream.read(_CHUNK)
        yield decode(b"", final=True).encode()

    for piece in xml_lexer.pieces(chunks()):
        yield from (x.decode() for x in records.feed(piece))
    if records.parts is not None:
        if not keep_unfinished:
            raise UnfinishedRecord(f"the stream ends inside a <{tag}> record")
        yield b"".join(records.parts).decode() + f"</{tag}>"


SPAN = 32 << 20  # compressed bytes of a member that one task reads
INDEX_SCHEMA = ("archive string, member string, data long, size long, stored boolean, single boolean, "
                "bit long, lo long, hi long, window binary, crc long")
_SPAN_KEY = ["archive", "member", "lo"]

# encodings whose bytes below 128 are ASCII wherever they stand, so that spans and byte ranges can be lexed undecoded
_ASCII_SAFE = re.compile(r"(utf-8(-sig)?|us-ascii|ascii|latin-?1|iso-8859-\d+|windows-125\d|cp125\d|koi8-[ru])$", re.I)


def ascii_safe(encoding: str) -> bool:
    """Can bytes in this encoding be lexed before they are decoded?"""
    return bool(_ASCII_SAFE.match(encoding))


def _members(member_suffix: str):
    """Central directory only: one row per XML member (no decompression)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                with open_file(path) as file, zipfile.ZipFile(file) as zf:
                    found = [i for i in zf.infolist() if not i.is_dir() and i.filename.endswith(member_suffix)]
                yield pa.record_batch({"archive": pa.array([path] * len(found), pa.string()),
                                       "member": pa.array([i.filename for i in found], pa.string())})
    return run


def _index(span: int):
    """Spans of each member: one for a small member, or one whose bytes cannot be lexed undecoded."""
    schema = pa.schema([("archive", pa.string()), ("member", pa.string()), ("data", pa.int64()), ("size", pa.int64()),
                        ("stored", pa.bool_()), ("single", pa.bool_()), ("bit", pa.int64()), ("lo", pa.int64()),
                        ("hi", pa.int64()), ("window", pa.binary()), ("crc", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, member in zip(batch.column("archive").to_pylist(), batch.column("member").to_pylist()):
                with open_file(path) as file, zipfile.ZipFile(file) as zf:
                    info = zf.getinfo(member)
                    with zf.open(member) as head:
                        safe = ascii_safe(declared_encoding(head.read(512)))
                    # the local header states the lengths of its name and extra field
                    local = file.read_at(4, info.header_offset + 26)
                    data = info.header_offset + 30 + int.from_bytes(local[:2], "little") + int.from_bytes(local[2:], "little")
                    stored = info.compress_type == zipfile.ZIP_STORED
                    points = [deflate_index.Point(0, 0, info.file_size, b"", 0)]
                    single = not safe or info.compress_size <= span or info.compress_type not in (zipfile.ZIP_STORED, zipfile.ZIP_DEFLATED)
                    if not single and stored:
                        points = [deflate_index.Point(8 * lo, lo, min(lo + span, info.file_size), b"", 0)
                                  for lo in range(0, info.file_size, span)]
                    elif not single:
                        points = deflate_index.access_points(lambda n, at: file.read_at(n, data + at), info.compress_size, span)
                yield pa.RecordBatch.from_pylist(
                    [{"archive": path, "member": member, "data": data, "size": info.compress_size, "stored": stored,
                      "single": single, **p._asdict()} for p in points], schema)
    return run


class _Span:
    """The bytes of a member from a span on, in order, asked for up to a place."""

    def __init__(self, file, r: dict):
        def read_at(n: int, at: int) -> bytes:
            return file.read_at(n, r["data"] + at)

        def stored() -> Iterator[bytes]:
            for at in range(r["lo"], r["size"], deflate_index.CHUNK):
                yield read_at(min(deflate_index.CHUNK, r["size"] - at), at)

        point = deflate_index.Point(*(r[f] for f in deflate_index.Point._fields))
        self.chunks = stored() if r["stored"] else deflate_index.inflated(read_at, r["size"], point)
        self.at, self.held = r["lo"], b""
        # the span begins with the first tag in it
        while self.at > 0:
            i = self.held.find(b"<")
            self.at += len(self.held) if i < 0 else i
            self.held = b"" if i < 0 else self.held[i:]
            if self.held or not self._more():
                break

    def _more(self) -> bool:
        chunk = next(self.chunks, None)
        self.held += chunk or b""
        return chunk is not None

    def until(self, hi: int) -> Iterator[bytes]:
        """Up to the first ``<`` at or after ``hi``, or to the end."""
        while True:
            end = self.held.find(b"<", max(0, hi - self.at)) if self.at + len(self.held) > hi else -1
            out = self.held if end < 0 else self.held[:end]
            self.at, self.held = self.at + len(out), self.held[len(out):]
            if out:
                yield out
            if end >= 0 or not self._more():
                return


def _span_maps(tag: str):
    """What each span does to every state that it may begin in."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                now = list(xml_lexer.STATES)
                with open_file(r["archive"]) as file:
                    for piece in xml_lexer.pieces(_Span(file, r).until(r["hi"])):
                        does = xml_lexer.piece_map(tag, piece)
                        now = [does[s] for s in now]
                out.append(bytes(now))
            yield pa.record_batch([*(batch.column(c) for c in _SPAN_KEY), pa.array(out, pa.binary())], [*_SPAN_KEY, "does"])
    return run


def _chained(table: pa.Table) -> pa.Table:
    """The state before each span of one member: nine bytes a span."""
    table = table.sort_by("lo")
    states = xml_lexer.chain(table.column("does").to_pylist())
    return table.drop_columns(["does"]).append_column("state", pa.array(states, pa.int32()))


def _span_records(tag: str):
    """The records that begin in each span, read on to their end."""
    def of(r: dict) -> Iterator[str]:
        with open_file(r["archive"]) as file:
            if r["single"]:
                with zipfile.ZipFile(file) as zf, zf.open(r["member"]) as stream:
                    yield from split_records(stream, tag)
                return
            with zipfile.ZipFile(file) as zf, zf.open(r["member"]) as head:
                encoding = declared_encoding(head.read(512))
            records, span = xml_lexer.Records(tag, r["state"]), _Span(file, r)
            for piece in xml_lexer.pieces(span.until(r["hi"])):
                yield from (x.decode(encoding) for x in records.feed(piece))
            hi = r["hi"]
            while records.parts is not None:
                hi = max(hi + deflate_index.CHUNK, span.at + 1)
                rest = list(span.until(hi))
                if not rest:
                    raise UnfinishedRecord(f"the stream ends inside a <{tag}> record")
                yield from (x.decode(encoding) for x in records.feed(b"".join(rest), only_open=True))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                held, size = [], 0
                for x in of(r):
                    held.append(x)
                    size += len(x)
                    if size >= 4 * _CHUNK:
                        yield _rows(r, held)
                        held, size = [], 0
                if held:
                    yield _rows(r, held)
    return run


def _rows(r: dict, held: list[str]) -> pa.RecordBatch:
    n = len(held)
    return pa.record_batch({"archive": pa.array([r["archive"]] * n, pa.string()), "member": pa.array([r["member"]] * n, pa.string()),
                            "record": pa.array(held, pa.string())})


ROOT_TAG = "regflat-records"


def _framer(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Wrap one partition's records in a single root element (holding one
    batch back to know which record is last)."""
    held = None
    for pdf in batches:
        if len(pdf) == 0:
            continue
        recs = pdf["record"].tolist()
        if held is None:
            recs[0] = f"<{ROOT_TAG}>" + recs[0]
        else:
            yield held
        held = pd.DataFrame({"record": recs})
    if held is not None:
        held.iloc[-1, 0] = held.iloc[-1, 0] + f"</{ROOT_TAG}>"
        yield held


def write_records_as_xml(records: DataFrame, path: str, column: str = "record") -> None:
    """Land record strings as XML text: one well-formed document per output
    file (Spark's XML reader needs a root element around several records)."""
    (records.select(column).toDF("record")
     .mapInPandas(_framer, "record string").write.text(path))


def list_archives(spark: SparkSession, root: str, glob: str = "*.zip") -> DataFrame:
    """Archive paths only; the binary content column is never materialised."""
    return (spark.read.format("binaryFile").option("pathGlobFilter", glob)
            .option("recursiveFileLookup", "true").load(root)
            .select("path", "length", "modificationTime"))


def expand_archives(spark: SparkSession, root: str, row_tag: str, member_suffix: str = ".xml",
                    glob: str = "*.zip", partitions: int | None = None, span: int = SPAN) -> DataFrame:
    """One row ``(archive, member, record)`` per XML record in the archives.

    Central directories are listed, members indexed (one task each; only a
    member of more than ``span`` compressed bytes is inflated for that), and
    spans read in parallel; only counts pass through the driver.  A span whose
    output is not what the index saw raises, and so does a record that its
    member ends in.
    """
    most = 4 * spark.sparkContext.defaultParallelism
    base = work_dir(spark, "archives")
    list_archives(spark, root, glob).select("path").mapInArrow(_members(member_suffix), "archive string, member string") \
        .write.parquet(f"{base}/members")
    members = spark.read.schema("archive string, member string").parquet(f"{base}/members")
    # round-robin over at most 4 tasks per core: one member per task while
    # members are few, no flood of tiny tasks when an archive holds thousands
    members.repartition(max(1, min(members.count(), most))).mapInArrow(_index(span), INDEX_SCHEMA).write.parquet(f"{base}/index")
    spans = spark.read.schema(INDEX_SCHEMA).parquet(f"{base}/index")
    n, several = spans.agg(F.count(F.lit(1)), F.count(F.when(~F.col("single"), 1))).first()
    tasks = max(1, min(n, max(most, several)))
    if several:
        state = spans.where("not single").repartition(tasks).mapInArrow(
            _span_maps(row_tag), "archive string, member string, lo long, does binary") \
            .groupBy("archive", "member").applyInArrow(_chained, "archive string, member string, lo long, state int")
        spans = spans.join(state, _SPAN_KEY, "left")
    else:
        spans = spans.withColumn("state", F.lit(None).cast("int"))
    spans = spans.withColumn("state", F.coalesce("state", F.lit(xml_lexer.OUT)))
    out = spans.repartition(tasks).mapInArrow(_span_records(row_tag), RECORD_SCHEMA)
    return out.repartition(partitions) if partitions else out
