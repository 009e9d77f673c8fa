"""A version's tables in one write, and the bad values counted by it."""

from __future__ import annotations

from pyspark.sql import functions as F

from regflat.functions.types import US_TYPE_RULES, bad_value_flags, quality_counts
from regflat.operators.rows import drop_null_rows
from regflat.operators.separate import Cleaning, extract_subtree
from regflat.functions.names import US_NAMES
from regflat.plans.publish import save_family
from regflat.plans.updates import observe_quality, write_quality
from regflat.session import work_dir
from regflat.sources.landing import inventory, mark_complete, complete_versions


def _jobs(spark, action) -> int:
    """Jobs that an action starts."""
    sc = spark.sparkContext
    group = work_dir(spark, "jobs")
    sc.setJobGroup(group, "counted")
    try:
        action()
        return len(sc.statusTracker().getJobIdsForGroup(group))
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)


def _family(spark, n: int):
    """Tables that share column names with unlike types; one in three is empty."""
    types = ("string", "bigint", "timestamp", "array<string>")
    base = spark.range(20)
    return {f"Table.{i}": base.select(F.col("id").alias("key"), F.lit(None).cast(types[i % 4]).alias("a|b"),
                                      (F.col("id") * i).alias("n")).where(F.lit(i % 3 != 2) & (F.col("id") < 5 + i)) for i in range(n)}


def test_family_comes_back_as_it_was(spark):
    family = _family(spark, 9)
    saved = save_family(family, work_dir(spark, "family"))
    assert set(saved) == set(family)
    for name, df in family.items():
        back = saved[name].read(spark)
        assert back.schema.simpleString() == df.schema.simpleString()
        assert sorted(map(str, back.collect())) == sorted(map(str, df.collect()))


def test_one_job_whatever_the_number_of_tables(spark):
    few, many = _family(spark, 2), _family(spark, 14)
    jobs = [_jobs(spark, lambda f=f: save_family(f, work_dir(spark, "family-jobs"))) for f in (few, many)]
    assert jobs == [1, 1]


def test_rewriting_a_family_leaves_nothing_behind(spark):
    folder = work_dir(spark, "family-again")
    save_family(_family(spark, 5), folder)
    saved = save_family({"Table.0": spark.range(3).select(F.col("id").alias("key"))}, folder)
    assert {r["table"] for r in inventory(spark, folder).select("table").distinct().collect()} == {"Table.0"}
    assert saved["Table.0"].read(spark).count() == 3


def test_no_tables(spark):
    assert save_family({}, work_dir(spark, "family-none")) == {}


def test_marker_keeps_what_the_landing_wrote(spark):
    landing = work_dir(spark, "family-marker")
    mark_complete(spark, landing, "gb", "v1", tables={"A": ("t0", "{}"), "B": (None, None)})
    mark_complete(spark, landing, "gb", "v1")
    assert complete_versions(spark, landing, "gb") == {"v1": {"A": ("t0", "{}"), "B": (None, None)}}


HOW = Cleaning(US_NAMES, None, tuple(US_TYPE_RULES), distinct=True)


def _headers(spark, rows):
    return spark.createDataFrame(rows, "`serial-number` string, header struct<`filing-date`:string,`mark-in`:string>")


def test_observed_counts_equal_a_pass_of_their_own(spark):
    rows = [(str(i), ("unknown" if i % 3 == 0 else "20010101", "T" if i % 2 else "maybe")) for i in range(40)] + [("x", None), ("y", (None, "F"))]
    for n, data in (("all", rows), ("none", [])):
        df = _headers(spark, data)
        with bad_value_flags():
            tables, counts = observe_quality({"header": extract_subtree(df, "header", ("serial-number",), HOW)})
        save_family(tables, work_dir(spark, f"observed-{n}"))
        path = work_dir(spark, f"observed-q-{n}")
        write_quality(spark, counts, path)
        raw = drop_null_rows(df.select("serial-number", "header.*"), ("serial-number",)).dropDuplicates()
        expected = quality_counts(raw, list(US_TYPE_RULES), "header")
        assert sorted(map(tuple, spark.read.parquet(path).collect())) == sorted(map(tuple, expected.collect()))


def test_copies_are_one_row_and_bad_if_any_copy_is(spark):
    df = _headers(spark, [("1", ("unknown", "T")), ("1", ("unknown", "T")), ("1", (None, "T")), ("2", ("20010101", None))])
    with bad_value_flags():
        tables, counts = observe_quality({"header": extract_subtree(df, "header", ("serial-number",), HOW)})
    saved = save_family(tables, work_dir(spark, "copies"))
    plain = extract_subtree(df, "header", ("serial-number",), HOW)
    assert sorted(map(str, saved["header"].read(spark).collect())) == sorted(map(str, plain.collect()))
    flags, seen = counts["header"]
    assert [seen.get[f"n{i}"] for i in range(len(flags))] == [1, 0]
