"""Archives, manifest, landing inventory, code seed."""

import os
import zipfile

from pyspark.sql import functions as F

from regflat.session import work_dir
from regflat.sources.archive import expand_archives
from regflat.sources.codes import read_codes, write_codes
from regflat.sources.landing import inventory, landed_tables, table_folder
from regflat.sources.manifest import anchors, concat_parts, manifest_rows
from tests.conftest import rows


def test_archives_split_per_member(spark):
    root = work_dir(spark, "zips")
    local = root.removeprefix("file:")
    os.makedirs(local)
    for a in range(2):
        with zipfile.ZipFile(f"{local}/a{a}.zip", "w", zipfile.ZIP_DEFLATED) as zf:
            for m in range(3):
                body = "<root>" + "".join(f"<rec><id>{a}-{m}-{i}</id></rec>" for i in range(5)) + "</root>"
                zf.writestr(f"m{m}.xml", body)
            zf.writestr("readme.txt", "<rec><id>no</id></rec>")
    recs = expand_archives(spark, root, "rec")
    assert recs.count() == 30
    assert recs.select("archive", "member").distinct().count() == 6
    assert recs.filter(F.col("record").contains("no")).count() == 0


def test_manifest_rows(spark):
    html = ('<ul><li><a href="/f/abc001.zip">weekly_001.zip</a></li><li><a href="/x/index.zip">index</a></li>'
            '<li><a href="/f/Schema.zip">Schema v1</a></li><li><a href="/f/b002.zip">bad name</a></li></ul>')
    pages = spark.createDataFrame([(1, html)], "id int, html string")
    links = anchors(pages).select("text", "href")
    m = manifest_rows(links, "file_name", "target", {"bad name": "good_002.zip"})
    got = rows(concat_parts(m), "file_name", "volume", "part_rank")
    assert got == [("good_002.zip", "002", 0), ("weekly_001.zip", "001", 0)]


def test_inventory_parses_layout(spark):
    landing = work_dir(spark, "inv")
    spark.range(3).write.parquet(table_folder(landing, "us", "200101", "case-file-header"))
    spark.range(3).write.parquet(table_folder(landing, "us", "200101", "delete"))
    inv = inventory(spark, landing)
    assert set(inv.select("office", "version", "table").distinct().collect()[0]) <= {"us", "200101",
                                                                                    "case-file-header", "delete"}
    assert rows(landed_tables(inv)) == [("us", "200101", "case-file-header")]


def test_code_seed_keeps_spaces(spark):
    path = work_dir(spark, "codes")
    seed = spark.createDataFrame([("t", "c", " ", "blank – dash"), ("t", "c", "1", "one, with comma")],
                                 "table_name string, column_name string, code string, description string")
    write_codes(seed, path)
    assert rows(read_codes(spark, path), "code", "description") == [(" ", "blank – dash"), ("1", "one, with comma")]
