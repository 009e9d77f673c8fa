"""Property: a record flattens to the same columns and rows whether each
nested element occurs once (struct) or as a one-element repetition (array)."""

from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import types as T

from regflat.operators.flatten import flatten_fully

NAMES = ["a", "b", "c"]


def trees(depth):
    leaf = st.just("leaf")
    if depth == 0:
        return leaf
    return st.one_of(leaf, st.dictionaries(st.sampled_from(NAMES), trees(depth - 1), min_size=1, max_size=3))


def schema_of(tree, repeated):
    fields = []
    for name, sub in tree.items():
        if sub == "leaf":
            dtype = T.StringType()
        else:
            dtype = schema_of(sub, repeated)
            if repeated:
                dtype = T.ArrayType(dtype)
        fields.append(T.StructField(name, dtype))
    return T.StructType(fields)


def value_of(tree, repeated, seed):
    out = []
    for i, (name, sub) in enumerate(tree.items()):
        if sub == "leaf":
            out.append(f"{seed}-{name}{i}")
        else:
            v = value_of(sub, repeated, f"{seed}.{name}")
            out.append([v] if repeated else v)
    return tuple(out)


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(tree=st.dictionaries(st.sampled_from(NAMES), trees(2), min_size=1, max_size=3))
def test_single_and_repeated_flatten_alike(spark, tree):
    top = {"k": "leaf", "rec": tree}
    dfs = []
    for repeated in (False, True):
        schema = schema_of(top, repeated)
        rows = [value_of(top, repeated, s) for s in ("r1", "r2")]
        dfs.append(flatten_fully(spark.createDataFrame(rows, schema)))
    single, repeated = dfs
    assert single.columns == repeated.columns
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(map(tuple, single.collect()), key=key) == sorted(map(tuple, repeated.collect()), key=key)
