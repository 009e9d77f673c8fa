"""Records of byte ranges against the records of the whole stream, wherever the ranges begin."""

import io
import os

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from regflat.session import work_dir
from regflat.sources import xml_lexer
from regflat.sources.archive import split_records
from regflat.sources.xml_records import _pieces, parse_strings, read_records, record_strings

PARTS = ["<rec>", "</rec>", "</rec >", "</rec\n>", "<rec a='1>2' b=\"x'<rec>\">", "<rec/>", "<rec a=\"1\"/>", "<rec a='<!--'/>",
         "<!-- <rec> ' -->", "<!-->", "-->", "<![CDATA[ </rec><rec> <!-- m --> ]]>", "]]>", "<recx>", "</recx>", "<v w='q>'>",
         "</v>", "text & 'quote\" ", "<", ">", "é", "<rec\n", "<!", "<![CDATA", "\n"]


class _File:
    def __init__(self, data):
        self.data = data

    def read_at(self, n, at):
        return self.data[at:at + n]


def whole(body: bytes):
    return list(split_records(io.BytesIO(body), "rec", "utf-8", keep_unfinished=True))


def by_ranges(body: bytes, size: int):
    """Both passes of the range scan, without Spark."""
    bounds = list(range(0, len(body), size))
    state, states = xml_lexer.OUT, []
    for lo in bounds:
        states.append(state)
        for _, piece in _pieces(_File(body), len(body), lo, min(lo + size, len(body))):
            state = xml_lexer.piece_map("rec", piece)[state]
    out = []
    for lo, s in zip(bounds, states):
        hi = min(lo + size, len(body))
        records = xml_lexer.Records("rec", s)
        for _, piece in _pieces(_File(body), len(body), lo, hi):
            out += [x.decode() for x in records.feed(piece)]
        if records.parts is not None:
            for _, piece in _pieces(_File(body), len(body), hi, len(body)):
                out += [x.decode() for x in records.feed(piece, only_open=True)]
                if records.parts is None:
                    break
            else:
                out.append(b"".join(records.parts).decode() + "</rec>")
    return out


@settings(max_examples=400, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.sampled_from(PARTS), max_size=30), st.integers(1, 40))
def test_ranges_equal_the_stream(parts, size):
    body = "".join(parts).encode()
    assert by_ranges(body, size) == whole(body)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(PARTS), max_size=20))
def test_piece_maps_equal_lexing(parts):
    piece = "".join(parts).encode()
    assert xml_lexer.piece_map("rec", piece) == [xml_lexer.lex("rec", piece, s)[0] for s in xml_lexer.STATES]


def _land(spark, body, name, encoding="utf-8", suffix=".xml"):
    path = work_dir(spark, name).replace("file://", "")
    os.makedirs(path)
    data = body.encode(encoding)
    if suffix.endswith(".gz"):
        import gzip
        data = gzip.compress(data)
    with open(f"{path}/feed{suffix}", "wb") as f:
        f.write(data)
    return path


TRICKY = ("<r>" + "".join(
    f"<!-- <rec>no {i}</rec> --><rec id='{i}'><v>a{i}<!-- </rec> --></v></rec >\n<rec id=\"{i}b\" w='>/'/>"
    f"<rec id='{i}c'><v><![CDATA[k <!-- </rec> --> n]]></v></rec\n>" for i in range(40)) + "</r>")


@pytest.mark.parametrize("size", [7, 50, 997, 1 << 20])
def test_tricky_records_from_any_ranges(spark, size):
    path = _land(spark, TRICKY, "tricky")
    got = record_strings(spark, path, "rec", range_bytes=size)
    assert sorted(r.record for r in got.collect()) == sorted(whole(TRICKY.encode()))
    schema = T.StructType([T.StructField(c, T.StringType()) for c in ("@id", "@w", "v")])
    rows = {r["@id"]: (r["@w"], r["v"]) for r in parse_strings(got, schema).collect()}
    assert len(rows) == 120
    for i in range(40):
        assert rows[str(i)] == (None, f"a{i}") and rows[f"{i}b"] == (">/", None)
        assert rows[f"{i}c"] == (None, "k <!-- </rec> --> n")


@pytest.mark.parametrize("encoding,suffix", [("utf-16", ".xml"), ("iso-8859-1", ".xml"), ("utf-8", ".xml.gz"), ("utf-8-sig", ".xml")])
def test_declared_encodings_and_compressed_files(spark, encoding, suffix):
    body = f'<?xml version="1.0" encoding="{encoding.removesuffix("-sig")}"?><r>' + "<rec><v>Café</v></rec>" * 30 + "</r>"
    got = record_strings(spark, _land(spark, body, "declared", encoding, suffix), "rec", range_bytes=64)
    assert [r.record for r in got.collect()] == ["<rec><v>Café</v></rec>"] * 30


def test_bad_records_raise_whatever_is_selected(spark):
    path = _land(spark, "<r><rec><v>1</v><w>1</w></rec><rec><v>2</rec></r>", "bad-any")
    schema = T.StructType([T.StructField("v", T.StringType()), T.StructField("w", T.StringType())])
    df = read_records(spark, path, "rec", schema)
    for action in (df.collect, df.count, df.select("w").collect, df.select("v").collect):
        with pytest.raises(Exception, match="BadRecords"):
            action()
    kept = read_records(spark, path, "rec", schema, on_bad="quarantine", quarantine=work_dir(spark, "bad-q"))
    assert kept.count() == 1


def test_nothing_to_read(spark):
    assert record_strings(spark, _land(spark, "<r></r>", "none"), "rec").collect() == []
    assert record_strings(spark, _land(spark, "", "empty"), "rec").collect() == []
