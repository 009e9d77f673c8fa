"""Name cleaning, pruning and type coercion (FIXTURES B)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from regflat.functions.names import CA_NAMES, EM_NAMES, GB_NAMES, NameCollision, clean_names, rename_columns
from regflat.functions.types import (GB_TYPE_RULES, ISO_TYPE_RULES, US_TYPE_RULES, apply_type_rules,
                                     quality_counts)
from regflat.operators.prune import CA_DROP, GB_DROP, US_UNNECESSARY, drop_by_rules, drop_present


@pytest.mark.parametrize("rules,raw,table,expected", [
    (CA_NAMES, "@com:operationCategory", None, "operationCategory"),
    (CA_NAMES, "com:ApplicationNumber|com:ST13ApplicationNumber", None, "ApplicationNumber|ST13ApplicationNumber"),
    (CA_NAMES, "tmk:ApplicantBag|tmk:Applicant|com:LegalEntityName", "ApplicantBag", "LegalEntityName"),
    (CA_NAMES, "cacom:FeeAmount|#text", None, "FeeAmount|text"),
    (CA_NAMES, "tmk:MarkEventBag|tmk:MarkEvent|@xsi:type", "MarkEventBag", "type"),
    (CA_NAMES, "tmk:Text|", None, "Text"),
    (EM_NAMES, "TradeMarkDetails|TradeMark|@operationCode", "TradeMarkDetails", "operationCode"),
    (EM_NAMES, "GoodsServicesDetails|GoodsServices|ClassDescriptionDetails|ClassDescription|"
               "GoodsServicesDescription|#text", "GoodsServicesDetails", "GoodsServicesDescription|text"),
    (GB_NAMES, "MarkLicenceeExportList|@ApplicationNumber", None, "ApplicationNumber"),
])
def test_clean_name(rules, raw, table, expected):
    assert rules.clean(raw, table) == expected


def test_prefix_renames_first_match_wins():
    long = ("MarkReproduction|MarkImageBag|MarkImage|MarkImageClassification|"
            "FigurativeElementClassificationBag|ViennaClassificationBag|ViennaClassification|"
            "ViennaDescriptionBag|ViennaDescription")
    assert CA_NAMES.rename(long) == "ViennaDescription"
    assert CA_NAMES.rename("MarkReproduction|MarkImageBag|MarkImage|X") == "MarkImage|X"
    assert CA_NAMES.rename("MarkReproduction|WordMarkSpecification|V") == "WordMarkSpecification|V"
    assert CA_NAMES.rename("Other|x") == "Other|x"


def test_collision_fails_at_plan_time(spark):
    df = spark.createDataFrame([(1, 2)], "`tmk:Name` int, `com:Name` int")
    with pytest.raises(NameCollision):
        clean_names(df, CA_NAMES)
    df2 = spark.createDataFrame([(1, 2)], "`a` int, `A` int")
    with pytest.raises(NameCollision):
        rename_columns(df2, lambda c: c)


def test_prune_rules(spark):
    cols = ["x|ClassificationKindCode", "CommentText", "a|type", "type", "FileFormat", "MyFileName",
            "NationalMarkEvent|MarkEventAdditionalText", "NationalOppositionCaseType", "keep",
            "MarkSeriesDetails|MarkSeriesItem|Mark3DModelX", "MarkSeriesDetails|MarkSeriesItem|MarkImageA",
            "MarkSeriesDetails|MarkSeriesItem|MarkImageText", "action-key", "classification|us-code"]
    df = spark.createDataFrame([tuple(range(len(cols)))], ", ".join(f"`{c}` int" for c in cols))
    out = drop_present(drop_by_rules(drop_by_rules(df, CA_DROP), GB_DROP), US_UNNECESSARY)
    assert out.columns == ["keep", "MarkSeriesDetails|MarkSeriesItem|MarkImageText"]


def test_us_types(spark):
    df = spark.createDataFrame(
        [("20200131", "T"), ("18840407", "F"), ("2020013", None), ("20201301", "Z"), ("0", "T"), (None, "F")],
        "`filing-date` string, `mark-in` string")
    out = apply_type_rules(df, US_TYPE_RULES).collect()
    got = [(r[0], r[1]) for r in out]
    assert got[0] == (dt.datetime(2020, 1, 31), True)
    assert got[1] == (dt.datetime(1884, 4, 7), False)
    assert [g[0] for g in got[2:]] == [None, None, None, None]
    assert [g[1] for g in got[2:]] == [False, None, True, False]
    q = quality_counts(df, US_TYPE_RULES, "t").collect()
    assert {(r["column"], r["n_bad"]) for r in q} == {("filing-date", 3), ("mark-in", 1)}


def test_iso_and_utc_types(spark):
    df = spark.createDataFrame([("2019-10-05", "true"), ("x", "false"), ("2019-10-05-04:00", None)],
                               "ApplicationDate string, UseIndicator string")
    got = [tuple(r) for r in apply_type_rules(df, ISO_TYPE_RULES).collect()]
    assert got == [(dt.datetime(2019, 10, 5), True), (None, False), (dt.datetime(2019, 10, 5), False)]
    g = spark.createDataFrame([("2019-10-05T10:00:00+01:00",)], "ApplicationDateTime string")
    ts = apply_type_rules(g, GB_TYPE_RULES).select(F.col("ApplicationDateTime").cast("timestamp_ntz")).first()[0]
    assert ts == dt.datetime(2019, 10, 5, 9, 0)


def test_type_rules_leave_containers(spark):
    df = spark.createDataFrame([(("a",),)], "MarkDateDetails struct<x:string>")
    out = apply_type_rules(df, GB_TYPE_RULES)
    assert out.schema == df.schema


def test_us_date_rule_is_segment_based(spark):
    df = spark.createDataFrame([("20200131", "20200131", "x")],
                               "`filing-date` string, `case-file-header|date-of-x` string, `update-note` string")
    out = apply_type_rules(df, US_TYPE_RULES)
    assert [f.dataType.typeName() for f in out.schema.fields] == ["timestamp", "timestamp", "string"]
