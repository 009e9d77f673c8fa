"""Row filters, null handling and distinct.

The change flag can be null; pandas kept such rows as live, and so do we,
by comparing with a null-safe predicate.
"""

from __future__ import annotations

import operator
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from regflat.operators.flatten import q


def split_deletes(df: DataFrame, flag: str, literal: str, keys: Sequence[str]) -> DataFrame:
    """keys of the rows flagged for deletion."""
    return df.filter(q(flag) == F.lit(literal)).select(*[q(k) for k in keys])


def live_rows(df: DataFrame, flag: str, literal: str) -> DataFrame:
    """every row not flagged for deletion (a null flag is live)."""
    return df.filter(~q(flag).eqNullSafe(F.lit(literal)))


def filter_equals(df: DataFrame, column: str, value: str) -> DataFrame:
    """rows whose column equals ``value`` (null never matches)."""
    if column not in df.columns:  # a missing column gives an empty table
        return df.filter(F.lit(False))
    return df.filter(q(column) == F.lit(value))


def drop_null_rows(df: DataFrame, except_columns: Sequence[str] = ()) -> DataFrame:
    """drop rows that are null in every column outside ``except_columns``.

    With no column left to test every row goes, as in the published code.
    """
    subset = [c for c in df.columns if c not in set(except_columns)]
    if not subset:
        return df.filter(F.lit(False))
    return df.filter(reduce(operator.or_, [q(c).isNotNull() for c in subset]))


def drop_all_null_rows(df: DataFrame) -> DataFrame:
    """drop rows null in every column."""
    return drop_null_rows(df, ())


def distinct_rows(df: DataFrame) -> DataFrame:
    """D1."""
    return df.dropDuplicates()


def distinct_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """D2."""
    return df.select(*[q(k) for k in keys]).distinct()
