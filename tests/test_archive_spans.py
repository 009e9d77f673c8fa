"""Large archive members read from access points by many tasks."""

import os
import random
import zipfile
import zlib

import pytest
from hypothesis import assume, given, settings
from hypothesis import strategies as st

from regflat.session import work_dir
from regflat.sources import archive, deflate_index, stores


def _text(seed, n):
    rng = random.Random(seed)
    words = ["".join(rng.choices("abcdefghijklmnopé<>&'\" ", k=rng.randint(2, 9))) for _ in range(900)]
    return " ".join(rng.choice(words) for _ in range(n)).encode()


@pytest.mark.parametrize("level", [1, 6, 9])
def test_every_point_resumes(level):
    data = _text(level, 250_000)
    c = zlib.compressobj(level, zlib.DEFLATED, -15)
    z = c.compress(data) + c.flush()

    def read_at(n, at):
        return z[at:at + n]

    points = deflate_index.access_points(read_at, len(z), 60_000)
    assert len(points) >= 5 and [p.lo for p in points[1:]] == [p.hi for p in points[:-1]]
    assert len({p.bit % 8 for p in points}) > 2  # blocks begin at any bit
    for p in points:
        assert b"".join(deflate_index.inflated(read_at, len(z), p)) == data[p.lo:]
    wrong = points[2]._replace(window=points[2].window[:-1] + b"\0", crc=points[2].crc ^ 1)
    with pytest.raises((deflate_index.BrokenIndex, zlib.error)):
        list(deflate_index.inflated(read_at, len(z), wrong))


@settings(max_examples=30, deadline=None)
@given(st.integers(0, 7), st.binary(max_size=200), st.binary(min_size=1, max_size=400))
def test_filling_blocks_put_out_nothing(bit, window, data):
    """A stream shifted to any bit is inflated from there, with any window."""
    c = zlib.compressobj(6, zlib.DEFLATED, -15, zdict=window) if window else zlib.compressobj(6, zlib.DEFLATED, -15)
    z = c.compress(data) + c.flush()
    assume(z[0] >> 1 & 3)  # a stored block begins at a byte, so it cannot be shifted
    shifted = (int.from_bytes(z, "little") << bit).to_bytes(len(z) + 1, "little")
    inflate, lead = deflate_index.resumed(shifted[0], bit, window)
    assert inflate.decompress(lead + shifted[1:]) == data


def _zip(spark, name, body, method):
    root = work_dir(spark, name)
    local = root.removeprefix("file://").removeprefix("file:")
    os.makedirs(local)
    with zipfile.ZipFile(f"{local}/a b.zip", "w", method) as zf:
        zf.writestr("m.xml", body)
        zf.writestr("small.xml", "<r><rec id='small'/></r>")
    return root


@pytest.mark.parametrize("method", [zipfile.ZIP_DEFLATED, zipfile.ZIP_STORED])
def test_one_member_in_many_tasks(spark, method):
    rng = random.Random(5)
    want, body = [], ["<r>"]
    for i in range(6000):
        text = "".join(rng.choices("abcdefgh é", k=rng.randint(1, 60)))
        rec = [f"<rec id='{i}'><v>{text}</v></rec>", f"<rec id='{i}' a='>'/>", f"<rec id='{i}'><v><![CDATA[</rec>{text}]]></v></rec >"][i % 3]
        want.append(rec)
        body += [f"<!-- <rec>{i}</rec> -->", rec]
    root = _zip(spark, f"spans-{method}", "".join([*body, "</r>"]), method)
    got = archive.expand_archives(spark, root, "rec", span=20_000)
    found = [r.record for r in got.collect()]
    assert sorted(found) == sorted([*want, "<rec id='small'/>"])
    from pyspark.sql import functions as F
    parts = got.where("member = 'm.xml'").select(F.spark_partition_id().alias("p")).distinct().count()
    assert parts > 1


def test_unfinished_and_foreign_encodings(spark):
    cut = _zip(spark, "spans-cut", "<r>" + "".join(f"<rec>{i * 7919}</rec>" for i in range(9000)) + "<rec>cut", zipfile.ZIP_DEFLATED)
    with pytest.raises(Exception, match="ends inside"):
        archive.expand_archives(spark, cut, "rec", span=5000).collect()
    body = '<?xml version="1.0" encoding="utf-16"?><r>' + "".join(f"<rec>é{i}</rec>" for i in range(500)) + "</r>"
    wide = _zip(spark, "spans-wide", body.encode("utf-16"), zipfile.ZIP_DEFLATED)
    got = {r.record for r in archive.expand_archives(spark, wide, "rec", span=100).collect()}
    assert got == {f"<rec>é{i}</rec>" for i in range(500)} | {"<rec id='small'/>"}


def test_paths_of_stores(tmp_path):
    """Local paths in every form that Spark lists; other schemes go to Arrow's file systems."""
    path = tmp_path / "a b=1%.txt"
    path.write_bytes(b"0123")
    for form in (str(path), f"file:{path}", f"file://{path}"):
        with stores.open_file(form) as f:
            assert f.read_at(2, 1) == b"12"
    where, at = stores.locate("mock://bucket/some file.zip")
    assert where.type_name == "mock" and at.endswith("some file.zip")
