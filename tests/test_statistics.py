"""Statistics of published columns from footers."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from regflat.plans.catalog import FROM_FOOTERS, column_statistics, statistics_plan
from regflat.plans.publish import session_conf
from regflat.session import work_dir

SCHEMA = "k bigint, `a|b` double, day date, text string, at timestamp, deep struct<x:int>, many array<int>"


def _table(spark, rows, parts=3):
    path = work_dir(spark, "statistics")
    spark.createDataFrame(rows, SCHEMA).repartition(parts).write.parquet(path)
    return path


def _row(k, number=None, day=None, text=None):
    return (k, number, day, text, None, (k,) if k else None, None)


def test_counts_and_bounds_over_files(spark):
    days = [datetime.date(2020, 1, 1) + datetime.timedelta(days=i) for i in range(30)]
    path = _table(spark, [_row(i, -0.0 if i == 3 else i / 2, days[i], None if i % 2 else "x") for i in range(30)] + [_row(None)] * 4)
    got = {r["column"]: r for r in column_statistics(spark, {"t": path}).collect()}
    assert set(got) == {"k", "a|b", "day", "text", "at", "deep", "many"} and {r["n_rows"] for r in got.values()} == {34}
    assert (got["k"]["n_nulls"], got["k"]["low_long"], got["k"]["high_long"]) == (4, 0, 29)
    assert (got["a|b"]["n_nulls"], str(got["a|b"]["low_double"]), got["a|b"]["high_double"]) == (4, "0.0", 14.5)
    assert (got["day"]["low_date"], got["day"]["high_date"]) == (days[0], days[-1])
    assert got["text"]["n_nulls"] == 19 and got["at"]["n_nulls"] == 34
    assert got["deep"]["n_nulls"] is None and got["many"]["n_nulls"] is None


def test_no_column_is_read(spark):
    path = _table(spark, [_row(1, 1.0)])
    with session_conf(spark, FROM_FOOTERS):
        plan = statistics_plan(spark, path)._jdf.queryExecution().explainString(
            spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    pushed = next(line for line in plan.splitlines() if "PushedAggregation" in line)
    assert "MIN(k)" in pushed and "COUNT(text)" in pushed and "COUNT(*)" in pushed


def test_empty_table_and_columns_without_values(spark):
    for path in (_table(spark, []), _table(spark, [_row(None)] * 2, 1)):
        got = {r["column"]: r for r in column_statistics(spark, {"t": path}).collect()}
        assert got["k"]["n_rows"] == got["k"]["n_nulls"] and got["k"]["low_long"] is None and got["k"]["high_long"] is None


def test_bounds_left_out_by_the_writer(spark):
    path = _table(spark, [_row(1, float("nan")), _row(2, 1.0)], 1)
    got = {r["column"]: r for r in column_statistics(spark, {"t": path}).collect()}
    assert (got["k"]["low_long"], got["k"]["high_long"], got["a|b"]["n_nulls"]) == (1, 2, 0)
    assert got["a|b"]["low_double"] == 1.0


def test_settings_are_put_back(spark):
    before = {k: spark.conf.get(k, None) for k in FROM_FOOTERS}
    column_statistics(spark, {"t": _table(spark, [_row(1)])})
    assert {k: spark.conf.get(k, None) for k in FROM_FOOTERS} == before
    assert spark.range(3).agg(F.max("id")).first()[0] == 2
