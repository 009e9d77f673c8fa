"""Schema-driven flatten.

A record read from XML is a row of nested structs and arrays.  Flattening
walks the *schema* on the driver and emits one ``select`` per step: struct
fields become ``parent|child`` columns and arrays are exploded with
``explode_outer`` (a missing or empty list keeps its row).  No data is
touched on the driver and no UDF is involved; each step is a narrow
Project/Generate that stays inside whole-stage codegen.

A field that occurs once in XML infers as a struct and one that repeats as
an array of structs; after a full flatten both give the same column names.
"""

from __future__ import annotations

import logging
from collections.abc import Collection

from pyspark.sql import Column, DataFrame, functions as F, types as T

from regflat.functions.names import SEP

log = logging.getLogger(__name__)


def q(name: str) -> Column:
    """Column reference that is safe for names with dots, pipes, ``@``, ``:``."""
    return F.col("`" + name.replace("`", "``") + "`")


def _is_nested(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.StructType, T.ArrayType))


def is_flat(df: DataFrame) -> bool:
    return not any(_is_nested(f.dataType) for f in df.schema.fields)


def _expand_structs(df: DataFrame) -> DataFrame:
    exprs: list[Column] = []
    changed = False
    for f in df.schema.fields:
        if isinstance(f.dataType, T.StructType):
            changed = True
            for child in f.dataType.fields:
                exprs.append(q(f.name).getField(child.name).alias(f"{f.name}{SEP}{child.name}"))
        else:
            exprs.append(q(f.name))
    return df.select(*exprs) if changed else df


def _explode_arrays(df: DataFrame) -> DataFrame:
    arrays = [f.name for f in df.schema.fields if isinstance(f.dataType, T.ArrayType)]
    if len(arrays) > 1:
        log.warning("exploding sibling arrays %s multiplies rows (cross product per record)", arrays)
    for name in arrays:
        exprs = [F.explode_outer(q(c)).alias(c) if c == name else q(c) for c in df.columns]
        df = df.select(*exprs)
    return df


def flatten_columns(df: DataFrame, names: Collection[str]) -> DataFrame:
    """N1 on some columns only: each struct one level, or each array one level."""
    exprs: list[Column] = []
    for f in df.schema.fields:
        if f.name in names and isinstance(f.dataType, T.StructType):
            exprs += [q(f.name).getField(child.name).alias(f"{f.name}{SEP}{child.name}") for child in f.dataType.fields]
        else:
            exprs.append(q(f.name))
    out = df.select(*exprs)
    for f in df.schema.fields:
        if f.name in names and isinstance(f.dataType, T.ArrayType):
            out = out.select(*[F.explode_outer(q(c)).alias(c) if c == f.name else q(c) for c in out.columns])
    return out


def flatten_once(df: DataFrame) -> DataFrame:
    """Expand every struct one level, then explode every array one level."""
    return _explode_arrays(_expand_structs(df))


def flatten_fully(df: DataFrame, max_steps: int = 64) -> DataFrame:
    """Repeat :func:`flatten_once` until only leaves remain."""
    for _ in range(max_steps):
        if is_flat(df):
            return df
        df = flatten_once(df)
    raise ValueError("schema still nested after max_steps flatten steps")


def flatten_steps(df: DataFrame, n: int) -> DataFrame:
    """N1 repeated ``n`` times (partial flatten)."""
    for _ in range(n):
        df = flatten_once(df)
    return df


def normalise_struct(df: DataFrame, column: str) -> DataFrame:
    """Replace struct ``column`` in place by ``column|child`` leaves."""
    field = df.schema[column]
    if not isinstance(field.dataType, T.StructType):
        return df
    exprs: list[Column] = []
    for c in df.columns:
        if c == column:
            exprs.extend(q(c).getField(ch.name).alias(f"{c}{SEP}{ch.name}")
                         for ch in field.dataType.fields)
        else:
            exprs.append(q(c))
    return df.select(*exprs)
