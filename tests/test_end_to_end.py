"""XML versions -> landing -> fold / single pass -> publish -> applications -> catalog."""

import os

from pyspark.sql import functions as F

from regflat.plans.applications import write_applications
from regflat.plans.catalog import catalog
from regflat.plans.offices import US
from regflat.plans.updates import run_office
from regflat.session import work_dir
from tests.conftest import rows


def _xml(spark, name, body):
    path = work_dir(spark, name)
    local = path.removeprefix("file:")
    os.makedirs(local)
    with open(f"{local}/v.xml", "w") as fh:
        fh.write(f"<file><action-keys>{body}</action-keys></file>")
    return path


def _case(serial, filing, status, classes=()):
    cls = "".join(f"<classification><international-code>{c}</international-code><us-code>1</us-code>"
                  f"</classification>" for c in classes)
    return (f"<case-file><serial-number>{serial}</serial-number><case-file-header><filing-date>{filing}"
            f"</filing-date><status-code>{status}</status-code></case-file-header>"
            f"<classifications>{cls}</classifications></case-file>")


def test_us_office_end_to_end(spark):
    v1 = _xml(spark, "us1", _case(1, "20200101", "600", ["9", "9"]) + _case(2, "20200102", "600", ["35"]))
    v2 = _xml(spark, "us2", _case(2, "20200102", "700", ["41"]) + _case(3, "20200103", "600"))
    versions = [("200101", 1, v1), ("200102", 2, v2)]
    results = {}
    for single, mode in ((True, "rewrite"), (False, "rewrite"), (False, "merge_on_read")):
        landing = work_dir(spark, "landing")
        out = run_office(spark, US, versions, landing, work_dir(spark, "store"), work_dir(spark, "up"),
                         single_pass=single, mode=mode)
        results.setdefault(single, out)
        from regflat.sources.xml_records import load_schema
        stored = load_schema(spark, f"{landing}/_schemas/office=us/version=200101")
        assert stored is not None and "case-file-header" in stored.fieldNames()
        header = spark.read.parquet(out["case-file-header"])
        assert rows(header, "serial-number", "status-code") == [("1", "600"), ("2", "700"), ("3", "600")]
        cls = spark.read.parquet(out["classifications"])
        assert "classification|us-code" not in cls.columns
        # duplicates dropped at merge; the empty container of 3 gives no child row
        assert rows(cls, "serial-number", "classification|international-code") == [("1", "9"), ("2", "41")]
    apps_path = work_dir(spark, "apps")
    write_applications({"us": spark.read.parquet(results[True]["case-file-header"])}, apps_path)
    apps = spark.read.parquet(apps_path)
    assert sorted(apps.columns) == sorted(["ip_office", "application_number", "application_date",
                                           "registration_date"])
    plan = apps.filter(F.col("ip_office") == "us")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ip_office" in plan
    assert apps.filter(F.col("application_date").isNull()).count() == 0
    cat = catalog(spark, {"open/us": results[True], "dataset": {"applications": apps_path}})
    assert cat.filter("file = 'applications'").count() == 4
    from regflat.plans.catalog import catalog_folders
    published = os.path.dirname(results[True]["case-file-header"])
    listed = catalog_folders(spark, {"open/us": published})
    assert {r["file"] for r in listed.collect()} == set(results[True])


def test_ca_versions_from_zip_archives(spark):
    import zipfile
    from regflat.plans.offices import CA
    from regflat.plans.snapshot import SnapshotStore
    from regflat.plans.updates import apply_in_order, land_archives

    def trademark(num, op, name):
        return (f'<tmk:Trademark com:operationCategory="{op}"><com:ApplicationNumber><com:ST13ApplicationNumber>'
                f'{num}</com:ST13ApplicationNumber></com:ApplicationNumber><tmk:ApplicationDate>2019-10-0{num}'
                f'</tmk:ApplicationDate><tmk:ApplicantBag><tmk:Applicant><com:LegalEntityName>{name}'
                f'</com:LegalEntityName></tmk:Applicant></tmk:ApplicantBag></tmk:Trademark>')

    landing = work_dir(spark, "ca-landing")
    for version, body in (("v1", trademark(1, "create", "A") + trademark(2, "create", "B")),
                          ("v2", trademark(1, "delete", "") + trademark(3, "create", "C"))):
        root = work_dir(spark, f"ca-zip-{version}")
        local = root.removeprefix("file:")
        os.makedirs(local)
        with zipfile.ZipFile(f"{local}/{version}.zip", "w", zipfile.ZIP_DEFLATED) as zf:
            zf.writestr("data.xml", f'<tmk:TrademarkBag xmlns:tmk="t" xmlns:com="c">{body}</tmk:TrademarkBag>')
        land_archives(spark, CA, root, landing, version)
    store = SnapshotStore(spark, work_dir(spark, "ca-store"), "ca")
    assert apply_in_order(store, CA, landing, [("v1", 1), ("v2", 2)])
    assert rows(store.current("Applicant"), "ApplicationNumber", "LegalEntityName") == [("2", "B"), ("3", "C")]
    assert rows(store.current("Trademark"), "ApplicationNumber") == [("2",), ("3",)]
    assert "operationCategory" not in store.current("Trademark").columns


def test_em_schema_specs():
    from regflat.plans.offices import em_spec
    assert em_spec("Applicant").keys == ("ApplicantIdentifier",)
    assert em_spec("InternationalRegistration").row_tag == "TradeMark"


def test_empty_version_lands_nothing_and_advances(spark):
    from regflat.plans.snapshot import SnapshotStore
    from regflat.plans.updates import apply_in_order, land_version
    landing = work_dir(spark, "empty-landing")
    v1 = _xml(spark, "e1", _case(1, "20200101", "600"))
    empty = _xml(spark, "e2", "")
    assert land_version(spark, US, v1, landing, "v1")
    assert land_version(spark, US, empty, landing, "v2") == {}
    store = SnapshotStore(spark, work_dir(spark, "empty-store"), "us")
    assert apply_in_order(store, US, landing, [("v1", 1), ("v2", 2)])
    assert store.latest_rank() == 2
    assert rows(store.current("case-file-header"), "serial-number") == [("1",)]
