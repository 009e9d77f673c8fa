"""Record -> table family.

A version is read once into a nested DataFrame; every output table is a
lazy projection of that parent: select the keys plus one container,
flatten, clean names, prune, drop all-null rows, coerce types, distinct.
``land_version`` stores the parent so the XML is parsed once per family, and
each table's scan is pruned to its own container.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, functions as F, types as T

from regflat.functions.names import NameRules, clean_names, shorten_prefixes
from regflat.functions.types import TypeRule, apply_type_rules, split_flags
from regflat.operators.flatten import SEP, flatten_columns, flatten_fully, flatten_steps, q
from regflat.operators.prune import DropRules, drop_by_rules
from regflat.operators.rows import drop_null_rows, live_rows, split_deletes


@dataclass(frozen=True)
class Cleaning:
    """Name, prune and type rules of one office."""

    names: NameRules
    drop: DropRules | None = None
    types: tuple[TypeRule, ...] = ()
    rename_prefixes: bool = False
    distinct: bool = True          # D1 on every separated table
    null_rule: str = "nonkey"      # F5 "nonkey": all-null outside keys; F6 "all": all-null everywhere


def _tidy(df: DataFrame, table: str | None, how: Cleaning) -> DataFrame:
    df = clean_names(df, how.names, table)
    if how.drop is not None:
        df = drop_by_rules(df, how.drop)
    if how.rename_prefixes:
        df = shorten_prefixes(df, how.names)
    return df


def _distinct(df: DataFrame) -> DataFrame:
    """D1 on the columns of the table; a row was bad if any of its copies was."""
    columns, flags = split_flags(df)
    if not flags:
        return df.dropDuplicates()
    return df.groupBy(*[q(c) for c in columns]).agg(*[F.max(q(c)).alias(c) for c in flags])


def _finish(df: DataFrame, keys: Sequence[str], how: Cleaning) -> DataFrame:
    df = drop_null_rows(df, keys if how.null_rule == "nonkey" else ())
    df = apply_type_rules(df, list(how.types))
    return _distinct(df) if how.distinct else df


def extract_partial(df: DataFrame, column: str, keys: Sequence[str], n_steps: int,
                    how: Cleaning, stop_at: Sequence[str] = ()) -> DataFrame:
    """Keys + one container, flatten steps, names, prune.

    Without ``stop_at`` exactly ``n_steps`` steps are taken.  With it the walk
    opens just the columns that hold one of the named sub-containers, as deep
    as it takes, until every one that the schema has is a column of its own;
    so neither the depth nor single versus repeated elements matter.
    """
    part = df.select(*[q(k) for k in keys], q(column))
    if not stop_at:
        return _tidy(flatten_steps(part, n_steps), column, how)
    targets = set(stop_at)

    def holds(name: str, dtype: T.DataType) -> bool:
        """Is there a target somewhere below a column (the column itself not counted)?"""
        if isinstance(dtype, T.ArrayType):
            return holds(name, dtype.elementType)
        return isinstance(dtype, T.StructType) and any(
            how.names.clean(f"{name}{SEP}{f.name}", column) in targets or holds(f"{name}{SEP}{f.name}", f.dataType)
            for f in dtype.fields)

    while True:
        closed = [f.name for f in part.schema.fields
                  if f.name not in keys and how.names.clean(f.name, column) not in targets and holds(f.name, f.dataType)]
        if not closed:
            return _tidy(part, column, how)
        part = flatten_columns(part, closed)


def finish_partial(df: DataFrame, name_table: str | None, keys: Sequence[str],
                   how: Cleaning) -> DataFrame:
    """Flatten the rest, names, prune, null rows, types, distinct."""
    return _finish(_tidy(flatten_fully(df), name_table, how), keys, how)


def extract_subtree(df: DataFrame, column: str, keys: Sequence[str], how: Cleaning,
                    null_except: Sequence[str] | None = None, strip_table: bool = True) -> DataFrame:
    """Keys + one container, fully flattened and finished."""
    part = df.select(*[q(k) for k in keys], q(column))
    return _finish(_tidy(flatten_fully(part), column if strip_table else None, how),
                   keys if null_except is None else null_except, how)


def is_container(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.StructType, T.ArrayType))


@dataclass(frozen=True)
class SuffixSeparation:
    """N7 for EM and GB: every top-level field ending in ``suffix`` becomes
    ``<prefix><field minus suffix>``; the rest is the main table."""

    keys: tuple[str, ...]
    main_table: str
    how: Cleaning
    suffix: str = "Details"
    table_prefix: str = ""
    strip_suffix_in_name: bool = True
    strip_table_prefix: bool = True
    skip: tuple[str, ...] = ()
    flag: str | None = None
    delete_literal: str | None = None
    special: dict = field(default_factory=dict)


def separate_by_suffix(df: DataFrame, spec: SuffixSeparation) -> dict[str, DataFrame]:
    out: dict[str, DataFrame] = {}
    if spec.flag and spec.flag in df.columns:
        out["delete"] = split_deletes(df, spec.flag, spec.delete_literal, spec.keys)
        df = live_rows(df, spec.flag, spec.delete_literal)
    for col in list(df.columns):
        if not col.endswith(spec.suffix):
            continue
        if col in spec.skip:
            df = df.drop(col)
            continue
        handler = spec.special.get(col)
        if handler is not None:
            out.update(handler(df, col, spec))
        else:
            name = col[: -len(spec.suffix)] if spec.strip_suffix_in_name else col
            out[spec.table_prefix + name] = extract_subtree(df, col, spec.keys, spec.how,
                                                            strip_table=spec.strip_table_prefix)
        df = df.drop(col)
    out[spec.main_table] = finish_partial(df, None, spec.keys, spec.how)
    return out


def separate_auto(df: DataFrame, keys: Sequence[str], how: Cleaning,
                  main_table: str | None = None) -> dict[str, DataFrame]:
    """N7-US: every top-level container becomes its own keyed table whose
    names lose the ``<container>|`` prefix; leftover leaves form ``main_table``."""
    out: dict[str, DataFrame] = {}
    containers = [f.name for f in df.schema.fields
                  if f.name not in keys and is_container(f.dataType)]
    for col in containers:
        out[col] = extract_subtree(df, col, keys, how)
    leaves = [c for c in df.columns if c not in containers]
    if main_table and len(leaves) > len(keys):
        out[main_table] = _finish(df.select(*[q(c) for c in leaves]), keys, how)
    return out
