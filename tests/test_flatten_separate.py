"""Flatten, separation and the XML path."""

from pyspark.sql import functions as F

from regflat.operators.flatten import flatten_fully, flatten_once, normalise_struct
from regflat.operators.rows import drop_all_null_rows, drop_null_rows, live_rows, split_deletes
from regflat.plans.offices import CA, EM, GB, US, normalise, prepare_new_rows
from regflat.session import work_dir
from regflat.sources.archive import split_records
from regflat.sources.xml_records import read_xml
from tests.conftest import rows


def test_single_vs_repeated_same_columns(spark):
    one = spark.createDataFrame([(1, ("a", "b"))], "k int, c struct<x:string,y:string>")
    many = spark.createDataFrame([(1, [("a", "b"), ("c", "d")])], "k int, c array<struct<x:string,y:string>>")
    assert flatten_fully(one).columns == flatten_fully(many).columns == ["k", "c|x", "c|y"]
    assert flatten_fully(many).count() == 2


def test_sibling_arrays_cross_product_and_empty_lists(spark):
    df = spark.createDataFrame([(1, ["a", "b"], ["x", "y"]), (2, [], None)],
                               "k int, a array<string>, b array<string>")
    out = flatten_fully(df)
    assert out.filter("k = 1").count() == 4
    assert rows(out.filter("k = 2")) == [(2, None, None)]


def test_flatten_once_is_one_level(spark):
    df = spark.createDataFrame([(1, (("v",),))], "k int, a struct<b:struct<c:string>>")
    assert flatten_once(df).columns == ["k", "a|b"]
    assert normalise_struct(df, "a").columns == ["k", "a|b"]


def test_null_rows_and_flags(spark):
    df = spark.createDataFrame([("k1", None, None), ("k2", "", None), (None, None, None), ("k3", None, "x")],
                               "k string, a string, b string")
    assert rows(drop_null_rows(df, ["k"]), "k") == [("k2",), ("k3",)]
    assert drop_all_null_rows(df).count() == 3
    assert drop_null_rows(df.select("k"), ["k"]).count() == 0
    flagged = spark.createDataFrame([("a", "delete"), ("b", None), ("c", "x")], "k string, op string")
    assert rows(live_rows(flagged, "op", "delete"), "k") == [("b",), ("c",)]
    assert rows(split_deletes(flagged, "op", "delete", ["k"])) == [("a",)]


def _land(spark, xml: str, name: str) -> str:
    path = work_dir(spark, name)
    import os
    local = path.removeprefix("file:")
    os.makedirs(local, exist_ok=True)
    with open(f"{local}/v.xml", "w") as fh:
        fh.write(xml)
    return path


US_XML = """<?xml version="1.0"?><file><action-keys><action-key>X</action-key>
<case-file><serial-number>1</serial-number>
  <case-file-header><filing-date>20200131</filing-date><registration-date>2020013</registration-date>
     <status-code>700</status-code><mark-in>T</mark-in></case-file-header>
  <classifications><classification><international-code>9</international-code><us-code>21</us-code>
     <status-code>6</status-code></classification>
     <classification><international-code>9</international-code><us-code>21</us-code><status-code>6</status-code></classification>
  </classifications>
  <case-file-owners><case-file-owner><party-type>10</party-type><party-name>A</party-name></case-file-owner></case-file-owners>
</case-file>
<case-file><serial-number>2</serial-number>
  <case-file-header><filing-date>19991231</filing-date><status-code>600</status-code></case-file-header>
</case-file></action-keys></file>"""


def test_us_family_from_xml(spark):
    df = read_xml(spark, _land(spark, US_XML, "us-xml"), US.row_tag)
    fam = normalise(US, df)
    assert {"case-file-header", "classifications", "case-file-owners"} <= set(fam)
    h = fam["case-file-header"]
    got = {r["serial-number"]: r for r in h.collect()}
    assert str(got["1"]["filing-date"])[:10] == "2020-01-31" and got["1"]["registration-date"] is None
    assert got["1"]["mark-in"] is True and got["2"]["mark-in"] is False
    c = fam["classifications"]
    assert "classification|international-code" in c.columns
    assert c.count() == 2  # landed as sent
    merged_in = prepare_new_rows(US, "classifications", c)
    assert "classification|us-code" not in merged_in.columns and merged_in.count() == 1
    owners = prepare_new_rows(US, "case-file-owners", fam["case-file-owners"])
    assert owners.count() == 1


CA_XML = """<tmk:TrademarkBag xmlns:tmk="t" xmlns:com="c">
<tmk:Trademark com:operationCategory="delete"><com:ApplicationNumber><com:ST13ApplicationNumber>9</com:ST13ApplicationNumber></com:ApplicationNumber></tmk:Trademark>
<tmk:Trademark com:operationCategory="create">
  <com:ApplicationNumber><com:ST13ApplicationNumber>1</com:ST13ApplicationNumber></com:ApplicationNumber>
  <tmk:ApplicationDate>2019-10-05</tmk:ApplicationDate>
  <tmk:ApplicantBag><tmk:Applicant><com:LegalEntityName>Acme</com:LegalEntityName></tmk:Applicant>
     <tmk:Applicant><com:LegalEntityName>Beta</com:LegalEntityName></tmk:Applicant></tmk:ApplicantBag>
  <tmk:GoodsServicesBag><tmk:GoodsServices><tmk:ClassDescriptionBag><tmk:ClassDescription><tmk:ClassNumber>9</tmk:ClassNumber></tmk:ClassDescription></tmk:ClassDescriptionBag>
     <tmk:Note>n</tmk:Note></tmk:GoodsServices></tmk:GoodsServicesBag>
  <tmk:MarkEventBag><tmk:MarkEvent><tmk:NationalMarkEvent><tmk:MarkEventCategory>Filed</tmk:MarkEventCategory>
     <tmk:MarkEventOtherLanguageDescriptionTextBag><tmk:Text>Deposee</tmk:Text></tmk:MarkEventOtherLanguageDescriptionTextBag>
  </tmk:NationalMarkEvent></tmk:MarkEvent></tmk:MarkEventBag>
  <tmk:LegalProceedingsBag><tmk:LegalProceedings><tmk:CancellationProceedings>
     <tmk:LegalProceedingIdentifier>L1</tmk:LegalProceedingIdentifier>
     <tmk:DefendantBag><tmk:Defendant><com:Name>D</com:Name></tmk:Defendant></tmk:DefendantBag>
  </tmk:CancellationProceedings>
  <tmk:OppositionProceedingBag><tmk:OppositionProceeding><tmk:OppositionIdentifier>O1</tmk:OppositionIdentifier>
     <tmk:PlaintiffBag><tmk:Plaintiff><com:Name>P</com:Name></tmk:Plaintiff></tmk:PlaintiffBag>
  </tmk:OppositionProceeding></tmk:OppositionProceedingBag></tmk:LegalProceedings></tmk:LegalProceedingsBag>
</tmk:Trademark></tmk:TrademarkBag>"""


def test_ca_family_from_xml(spark):
    df = read_xml(spark, _land(spark, CA_XML, "ca-xml"), CA.row_tag)
    fam = normalise(CA, df)
    assert rows(fam["delete"]) == [("delete", "9")]
    assert rows(fam["Applicant"], "ApplicationNumber", "LegalEntityName") == [("1", "Acme"), ("1", "Beta")]
    assert "GoodsServices.ClassDescription" in fam
    assert rows(fam["GoodsServices.ClassDescription"], "ApplicationNumber", "ClassNumber") \
        == [("1", "9")]
    t = fam["Trademark"]
    r = t.collect()
    assert len(r) == 1 and str(r[0]["ApplicationDate"])[:10] == "2019-10-05"
    assert "CancellationProceedings" in fam and "CancellationProceedings.Defendant" in fam
    assert "LegalProceedingIdentifier" in fam["CancellationProceedings.Defendant"].columns
    assert rows(fam["OppositionProceedings.Plaintiff"], "OppositionIdentifier", "Name") == [("O1", "P")]
    assert rows(fam["CancellationProceedings.Defendant"], "LegalProceedingIdentifier", "Name") == [("L1", "D")]
    me = fam["MarkEvent"]
    assert not [c for c in me.columns if "OtherLanguage" in c]
    assert rows(me, "ApplicationNumber") == [("1",)]


EM_XML = """<Transaction><TradeMarkDetails>
<TradeMark operationCode="Delete"><ApplicationNumber>7</ApplicationNumber></TradeMark>
<TradeMark operationCode="Insert"><ApplicationNumber>1</ApplicationNumber><ApplicationDate>2019-10-05</ApplicationDate>
 <GoodsServicesDetails><GoodsServices><ClassNumber>9</ClassNumber>
   <ClassDescriptionDetails><ClassDescription>
     <GoodsServicesDescription languageCode="en">Software</GoodsServicesDescription>
     <GoodsServicesDescription languageCode="fr">Logiciel</GoodsServicesDescription>
   </ClassDescription></ClassDescriptionDetails></GoodsServices></GoodsServicesDetails>
 <PriorityDetails><Priority><PriorityNumber>P1</PriorityNumber></Priority></PriorityDetails>
</TradeMark></TradeMarkDetails></Transaction>"""


def test_em_family_from_xml(spark):
    from regflat.functions.names import EM_NAMES, clean_names
    df = clean_names(read_xml(spark, _land(spark, EM_XML, "em-xml"), EM.row_tag), EM_NAMES)
    fam = normalise(EM, df)
    assert rows(fam["delete"]) == [("Delete", "7")]  # landed tables carry the operation code beside the key
    assert rows(fam["TradeMark.GoodsServices"], "ApplicationNumber", "ClassNumber") == [("1", "9")]
    assert fam["TradeMark.GoodsServices"].columns[0] == "operationCode"
    d = fam["TradeMark.GoodsServices.Description"]
    assert rows(d, "GoodsServicesDescription|text") == [("Software",)]
    assert rows(fam["TradeMark.Priority"], "ApplicationNumber", "PriorityNumber") == [("1", "P1")]
    assert fam["TradeMark"].count() == 1


GB_XML = """<MarkLicenceeExportList><TradeMark><ApplicationNumber>1</ApplicationNumber>
<ApplicationDateTime>2019-10-05T10:00:00+01:00</ApplicationDateTime>
<MarkImageDetails><MarkImage><Big>x</Big></MarkImage></MarkImageDetails>
<MarkSeriesDetails><MarkSeriesItem><Mark3DModelA>a</Mark3DModelA><MarkImageB>b</MarkImageB><MarkImageText>t</MarkImageText></MarkSeriesItem></MarkSeriesDetails>
</TradeMark></MarkLicenceeExportList>"""


def test_gb_family_from_xml(spark):
    df = read_xml(spark, _land(spark, GB_XML, "gb-xml"), GB.row_tag)
    fam = normalise(GB, df)
    assert set(fam) == {"MarkSeriesDetails", "Application"}
    assert fam["Application"].count() == 1
    ms = fam["MarkSeriesDetails"]
    assert ms.columns == ["ApplicationNumber", "MarkSeriesDetails|MarkSeriesItem|MarkImageText"]
    app = fam["Application"].select(F.col("ApplicationDateTime").cast("timestamp_ntz")).first()[0]
    assert str(app) == "2019-10-05 09:00:00"


def test_split_records_streams_across_chunks():
    import io
    from regflat.sources import archive
    body = "<r>" + "".join(f"<rec id='{i}'><v>{'x' * 50}</v></rec>" for i in range(500)) + "<rec/></r>"
    old = archive._CHUNK
    archive._CHUNK = 97
    try:
        got = list(split_records(io.BytesIO(body.encode()), "rec"))
    finally:
        archive._CHUNK = old
    assert len(got) == 501 and got[0].startswith("<rec id='0'>") and got[-1] == "<rec/>"


def test_em_missing_columns_give_empty_tables(spark):
    from regflat.functions.names import EM_NAMES, clean_names
    xml = ("<T><TradeMark><ApplicationNumber>1</ApplicationNumber><GoodsServicesDetails><GoodsServices>"
           "<Other>x</Other></GoodsServices></GoodsServicesDetails></TradeMark></T>")
    df = clean_names(read_xml(spark, _land(spark, xml, "em-r9"), EM.row_tag), EM_NAMES)
    fam = normalise(EM, df)
    assert fam["TradeMark.GoodsServices"].count() == 0
    assert fam["TradeMark.GoodsServices.Description"].count() == 0
    assert "ClassNumber" in fam["TradeMark.GoodsServices"].columns


def test_em_narrowing_from_transaction_level(spark):
    from regflat.plans.offices import separate_em
    xml = ("<Transaction><TransactionData><TradeMarkDetails>"
           "<TradeMark operationCode='Insert'><ApplicationNumber>1</ApplicationNumber>"
           "<ApplicationDate>2019-10-05</ApplicationDate></TradeMark>"
           "<TradeMark operationCode='Delete'><ApplicationNumber>2</ApplicationNumber></TradeMark>"
           "</TradeMarkDetails></TransactionData></Transaction>")
    df = read_xml(spark, _land(spark, xml, "em-p12"), "TransactionData")
    fam = separate_em(df, record_column="TradeMarkDetails")
    assert rows(fam["delete"]) == [("Delete", "2")]
    main = fam["TradeMark"].collect()
    assert len(main) == 1 and main[0]["ApplicationNumber"] == "1" and str(main[0]["ApplicationDate"])[:10] == "2019-10-05"


def test_landing_writes_quality_table(spark):
    from regflat.plans.updates import land_version, quality_path
    landing = work_dir(spark, "quality-landing")
    land_version(spark, US, _land(spark, US_XML, "us-quality"), landing, "v1")
    q = {(r["table"], r["column"]): r["n_bad"] for r in spark.read.parquet(quality_path(landing, "us", "v1")).collect()}
    # the bad registration date of record 1 is counted; good filing dates are not
    assert q[("case-file-header", "registration-date")] == 1
    assert q[("case-file-header", "filing-date")] == 0


def test_split_records_quote_aware_tag_end():
    import io
    body = '<r><rec a="x>y"/><rec b=\'1>2\'><v>1</v></rec><rec/></r>'
    got = list(split_records(io.BytesIO(body.encode()), "rec"))
    assert got == ['<rec a="x>y"/>', "<rec b='1>2'><v>1</v></rec>", "<rec/>"]


def test_split_records_comments_encoding_and_truncation():
    import io
    import zipfile  # noqa: F401

    import pytest

    from regflat.sources import archive
    body = "<r><!-- <rec>no</rec> --><rec><v>a<!-- </rec> --><![CDATA[</rec>]]></v></rec><rec>é</rec></r>"
    for chunk in (7, 1 << 20):
        old, archive._CHUNK = archive._CHUNK, chunk
        try:
            got = list(split_records(io.BytesIO(body.encode()), "rec"))
            assert got == ["<rec><v>a<!-- </rec> --><![CDATA[</rec>]]></v></rec>", "<rec>é</rec>"]
            latin = '<?xml version="1.0" encoding="ISO-8859-1"?><r><rec>Café</rec></r>'.encode("latin-1")
            assert list(split_records(io.BytesIO(latin), "rec")) == ["<rec>Café</rec>"]
            for cut in ("<r><rec>a</rec><rec>b", "<r><rec>a</rec><rec a='1", "<r><rec>a</rec><rec>b</re"):
                with pytest.raises(archive.UnfinishedRecord):
                    list(split_records(io.BytesIO(cut.encode()), "rec"))
            with pytest.raises(UnicodeDecodeError):
                list(split_records(io.BytesIO(b"<r><rec>\xe9</rec></r>"), "rec"))
        finally:
            archive._CHUNK = old


def test_record_strings_split_and_isolate(spark):
    """One pretty-printed file is read by several tasks, with the same records as its source."""
    from regflat.plans.publish import session_conf
    from regflat.sources.xml_records import BadRecords, parse_strings, read_records, record_schema, record_strings  # noqa: F401

    body = "<r>\n" + "".join(f"  <rec id='{i}'>\n    <v>\n{'x' * 40}</v>\n  </rec>\n" for i in range(20000)) + "</r>"
    path = _land(spark, body, "split-one")
    with session_conf(spark, {"spark.sql.files.maxPartitionBytes": "256k", "spark.sql.files.openCostInBytes": "1k"}):
        strings = record_strings(spark, path, "rec")
        assert strings.rdd.getNumPartitions() >= 4
        df = read_records(spark, path, "rec", record_schema(spark, path, "rec"))
        assert df.count() == 20000 and df.select("`@id`").distinct().count() == 20000
    bad = _land(spark, "<r><rec><v>1</v></rec><rec><v>2</rec><rec><v>3</v></rec><rec><v>4</v>", "split-bad")
    schema = record_schema(spark, _land(spark, "<r><rec><v>1</v></rec></r>", "split-ok"), "rec")
    q1 = work_dir(spark, "split-q")
    kept = read_records(spark, bad, "rec", schema, on_bad="quarantine", quarantine=q1)
    # the record cut off at the end has a matching closing tag put back only if all inside it is whole
    assert {r["v"] for r in kept.collect()} >= {"1", "3"} and spark.read.parquet(q1).count() == 1
    import pytest
    with pytest.raises(Exception, match="BadRecords"):
        read_records(spark, bad, "rec", schema).collect()


def test_partial_walk_finds_siblings_at_any_depth(spark):
    from regflat.operators.separate import extract_partial
    from regflat.plans.offices import CA_CLEAN
    df = spark.createDataFrame([(1, ([("k1", [("s1",)], (([("d1",)],),))],))],
                               "key int, TopBag struct<Top:array<struct<Id:string,StageBag:array<struct<S:string>>,"
                               "Deep:struct<More:struct<PartyBag:array<struct<P:string>>>>>>>")
    part = extract_partial(df, "TopBag", ["key"], 1, CA_CLEAN, stop_at=("StageBag", "Deep|More|PartyBag"))
    assert {"StageBag", "Deep|More|PartyBag", "Id"} <= set(part.columns)
    assert part.select("`Deep|More|PartyBag`.P").first()[0] == ["d1"]
