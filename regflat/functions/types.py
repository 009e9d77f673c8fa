"""Name-driven type rules (K5-K9) as built-in column expressions.

Every leaf is read as text; a rule picks columns by name at plan time and
rewrites them with JVM-side expressions (no UDF).  Unparseable text becomes
null; :func:`quality_counts` reports how many values each rule nulled.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F, types as T


def compact_date(c: Column) -> Column:
    """K5: ``yyyyMMdd`` text to timestamp; malformed text gives null."""
    return F.try_to_timestamp(c.cast("string"), F.lit("yyyyMMdd"))


# A bare ISO date followed by a zone offset, e.g. ``2019-10-05-04:00``.
_DATE_WITH_OFFSET = r"^(\d{4}-\d{2}-\d{2})[+-]\d{2}:\d{2}$"


def iso_timestamp(c: Column) -> Column:
    """K6: free ISO text to timestamp; a date-only offset is dropped first."""
    text = F.regexp_replace(c.cast("string"), _DATE_WITH_OFFSET, "$1")
    return text.try_cast("timestamp")


def utc_timestamp(c: Column) -> Column:
    """K7: ISO text with or without an offset, as an instant.

    With the session zone pinned to UTC (see ``session.DEFAULT_CONF``) the
    value is shown as UTC wall-clock time.
    """
    return iso_timestamp(c)


def indicator(c: Column, true_text: str, false_text: str) -> Column:
    """K8/K9: null -> false, true_text -> true, false_text -> false, other -> null."""
    return (F.when(c.isNull(), F.lit(False))
            .when(c == F.lit(true_text), F.lit(True))
            .when(c == F.lit(false_text), F.lit(False))
            .otherwise(F.lit(None).cast("boolean")))


def indicator_tf(c: Column) -> Column:
    return indicator(c, "T", "F")


def indicator_words(c: Column) -> Column:
    return indicator(c, "true", "false")


@dataclass(frozen=True)
class TypeRule:
    """Which columns a coercion applies to, decided on the name only."""

    name: str
    matches: Callable[[str], bool]
    convert: Callable[[Column], Column]
    leaves_only: bool = True


def _leaf(dtype: T.DataType) -> bool:
    return not isinstance(dtype, (T.StructType, T.ArrayType, T.MapType))


def _nulled(rule: TypeRule, text: Column) -> Column:
    """A value that is there as text and that the rule turns into null."""
    return text.isNotNull() & rule.convert(text).isNull()


def _apply(df: DataFrame, rules: list[TypeRule], flags: bool = False) -> tuple[DataFrame, list[tuple[str, str]]]:
    exprs, touched, bad = [], [], []
    for f in df.schema.fields:
        rule = next((r for r in rules if r.matches(f.name)), None)
        if rule is not None and (_leaf(f.dataType) or not rule.leaves_only) \
                and isinstance(f.dataType, T.StringType):
            exprs.append(rule.convert(F.col(f"`{f.name}`")).alias(f.name))
            touched.append((f.name, rule.name))
            if flags:
                bad.append(_nulled(rule, F.col(f"`{f.name}`")).alias(f"{BAD_FLAG}{rule.name}|{f.name}"))
        else:
            exprs.append(F.col(f"`{f.name}`"))
    return (df.select(*exprs, *bad) if touched else df), touched


BAD_FLAG = "?bad|"  # no XML name begins so
_FLAGGING: ContextVar[bool] = ContextVar("regflat_flag_bad_values", default=False)


@contextmanager
def bad_value_flags() -> Iterator[None]:
    """Plans built inside this block carry, behind the columns of a table, one
    boolean ``?bad|<rule>|<column>`` per coerced column: the value was text
    that the rule could not read.  ``split_flags`` parts them again."""
    token = _FLAGGING.set(True)
    try:
        yield
    finally:
        _FLAGGING.reset(token)


def split_flags(df: DataFrame) -> tuple[list[str], list[str]]:
    """Column names of a table, and of the flags behind them."""
    flags = [c for c in df.columns if c.startswith(BAD_FLAG)]
    return [c for c in df.columns if not c.startswith(BAD_FLAG)], flags


def flagged(flag: str) -> tuple[str, str]:
    """(column, rule) of a flag."""
    rule, column = flag.removeprefix(BAD_FLAG).split("|", 1)
    return column, rule


def apply_type_rules(df: DataFrame, rules: list[TypeRule]) -> DataFrame:
    """Coerce every matching string leaf; the first matching rule wins."""
    return _apply(df, rules, _FLAGGING.get())[0]


def quality_counts(df: DataFrame, rules: list[TypeRule], table: str) -> DataFrame:
    """Rows ``(table, column, rule, n_bad)``: values present as text that the
    rule turned into null.  One pass, one partial aggregate per column."""
    _, touched = _apply(df, rules)
    if not touched:
        spark = df.sparkSession
        return spark.createDataFrame([], "table string, column string, rule string, n_bad bigint")
    by_name = {r.name: r for r in rules}
    aggs = []
    for col_name, rule_name in touched:
        aggs.append(F.count_if(_nulled(by_name[rule_name], F.col(f"`{col_name}`"))).alias(f"n{len(aggs)}"))
    counts = df.agg(*aggs)
    stack = ", ".join(
        f"'{c.replace(chr(39), chr(39) * 2)}', '{r}', n{i}" for i, (c, r) in enumerate(touched))
    return counts.selectExpr(
        f"'{table}' AS `table`",
        f"stack({len(touched)}, {stack}) AS (`column`, `rule`, `n_bad`)")


def has_segment(name: str, word: str) -> bool:
    """``word`` is a whole segment of a flattened, hyphenated name."""
    return word in re.split(r"[|\-]", name)


# Office rule sets (name predicates are the fixed parts of the rules).
# US dates: the published rule matched the substring "date" (so "update-..."
# columns were nulled too); we match "date" as a whole name segment.
US_TYPE_RULES = [
    TypeRule("us_date", lambda n: has_segment(n, "date"), compact_date),
    TypeRule("us_indicator", lambda n: n.endswith("-in"), indicator_tf),
]
ISO_TYPE_RULES = [  # CA and EM
    TypeRule("iso_date", lambda n: n.endswith("Date"), iso_timestamp),
    TypeRule("indicator", lambda n: n.endswith("Indicator"), indicator_words),
]
GB_TYPE_RULES = [
    TypeRule("utc_date", lambda n: "Date" in n, utc_timestamp),
]
