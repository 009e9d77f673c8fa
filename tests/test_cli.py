"""python -m regflat office / applications / catalog on a small US feed."""

import os

from regflat.__main__ import main
from regflat.session import work_dir


def test_cli_office_applications_catalog(spark, capsys):
    root = work_dir(spark, "cli-feed")
    for name, body in (("2001", "<case-file><serial-number>1</serial-number><case-file-header>"
                                "<filing-date>20010101</filing-date></case-file-header></case-file>"),
                       ("2002", "<case-file><serial-number>1</serial-number><case-file-header>"
                                "<filing-date>20020202</filing-date></case-file-header></case-file>")):
        d = f"{root}/{name}".removeprefix("file:")
        os.makedirs(d)
        with open(f"{d}/feed.xml", "w") as fh:
            fh.write(f"<file><action-keys>{body}</action-keys></file>")
    landing, store, pub = work_dir(spark, "cli-land"), work_dir(spark, "cli-store"), work_dir(spark, "cli-pub")
    main(["office", "--office", "us", "--versions", root, "--landing", landing, "--store", store,
          "--publish", pub, "--single-pass"])
    out = capsys.readouterr().out
    assert "case-file-header" in out
    header = spark.read.parquet(f"{pub}/case-file-header.parquet")
    assert [str(r[0])[:10] for r in header.select("filing-date").collect()] == ["2002-02-02"]
    apps = work_dir(spark, "cli-apps")
    main(["applications", "--office", f"us={pub}", "--out", apps])
    assert spark.read.parquet(apps).count() == 1
    main(["catalog", "--folder", f"open/us={pub}"])
    assert "filing-date" in capsys.readouterr().out


def test_cli_versions_follow_phases(spark):
    from regflat.__main__ import _versions
    root = work_dir(spark, "cli-phases")
    for folder in ("rollup/a-new", "full/z-old", "full/y-old", "rollup_old/m"):
        d = f"{root}/{folder}".removeprefix("file:")
        os.makedirs(d)
        with open(f"{d}/x.xml", "w") as fh:
            fh.write("<r/>")
    got = [(name, rank) for name, rank, _, _ in _versions(spark, root)]
    assert got == [("full__y-old", 1), ("full__z-old", 2), ("rollup_old__m", 3), ("rollup__a-new", 4)]


def test_cli_versions_of_the_published_layout(spark):
    import pytest

    from regflat.__main__ import _versions
    root = work_dir(spark, "cli-published")
    names = ["full/2.zip", "full/1.zip", "rollup/rollup.zip", "rollup/rollup_old.zip", "new/rollup.zip"]
    for name in names:
        f = f"{root}/{name}".removeprefix("file:")
        os.makedirs(os.path.dirname(f), exist_ok=True)
        with open(f, "wb") as fh:
            fh.write(b"x")
    got = [(name, path.removeprefix(root + "/"), zipped) for name, _, path, zipped in _versions(spark, root)]
    assert got == [("full__1", "full/1.zip", True), ("full__2", "full/2.zip", True),
                   ("rollup__rollup_old", "rollup/rollup_old.zip", True), ("rollup__rollup", "rollup/rollup.zip", True),
                   ("new__rollup", "new/rollup.zip", True)]
    os.makedirs(f"{root}/other".removeprefix("file:"))
    with open(f"{root}/other/x.zip".removeprefix("file:"), "wb") as fh:
        fh.write(b"x")
    with pytest.raises(Exception, match="unknown phase"):
        _versions(spark, root)


def test_cli_gb_zipped_phases(spark):
    import zipfile
    root = work_dir(spark, "cli-gb")

    def feed(folder, records):
        d = f"{root}/{folder}".removeprefix("file:")
        os.makedirs(d)
        body = "".join(f"<TradeMark><ApplicationNumber>{k}</ApplicationNumber>"
                       f"<ApplicationDateTime>{ts}</ApplicationDateTime></TradeMark>" for k, ts in records)
        with zipfile.ZipFile(f"{d}/part.zip", "w", zipfile.ZIP_DEFLATED) as zf:
            zf.writestr("export.xml", f"<MarkLicenceeExportList>{body}</MarkLicenceeExportList>")
    feed("full/b", [("1", "2001-01-01T00:00:00Z"), ("2", "2001-01-02T00:00:00Z")])
    feed("rollup/a", [("1", "2005-05-05T10:00:00+01:00")])   # sorts first by name, applies last by phase
    landing, store, pub = work_dir(spark, "cli-gb-land"), work_dir(spark, "cli-gb-store"), work_dir(spark, "cli-gb-pub")
    main(["office", "--office", "gb", "--versions", root, "--landing", landing, "--store", store, "--publish", pub])
    app = spark.read.parquet(f"{pub}/Application.parquet")
    got = sorted((r["ApplicationNumber"], str(r["ApplicationDateTime"])) for r in
                 app.selectExpr("ApplicationNumber", "CAST(ApplicationDateTime AS timestamp_ntz) AS ApplicationDateTime").collect())
    assert got == [("1", "2005-05-05 09:00:00"), ("2", "2001-01-02 00:00:00")]
