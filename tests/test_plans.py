"""Plan properties the design relies on (checked on the physical plan)."""

import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


def plan(spark, name):
    df = E.queries()[name](spark, SF)
    return df._jdf.queryExecution().executedPlan().toString()


def test_merge_pushes_delta_filter_and_anti_joins(spark):
    p = plan(spark, "merge_multi_row_key")
    assert "LeftAnti" in p
    assert "PushedFilters: [IsNotNull(l_returnflag), EqualTo(l_returnflag,R)]" in p


def test_filter_and_projection_reach_the_scan(spark):
    p = plan(spark, "english_descriptions")
    assert "EqualTo(lang,en)" in p
    assert "ReadSchema: struct<text:string,lang:string,source:string>" in p


@pytest.mark.parametrize("name", ["bulk_merge", "merge_delete_replace", "merge_null_keys"])
def test_merges_have_no_window_or_nested_loop(spark, name):
    p = plan(spark, name)
    assert "Window" not in p and "NestedLoopJoin" not in p and "CartesianProduct" not in p


def test_applications_union_needs_no_shuffle(spark):
    assert "Exchange" not in plan(spark, "applications_union")


def test_distinct_is_combined_map_side(spark):
    p = plan(spark, "distinct_keys")
    assert p.count("HashAggregate") >= 2 and "Exchange" in p


def test_flatten_is_projection_and_generate_only(spark):
    p = plan(spark, "flatten_cross_product")
    assert "Generate" in p and "Exchange" not in p and "PythonUDF" not in p and "BatchEvalPython" not in p
