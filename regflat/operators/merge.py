"""Keyed change-data merge (J1-J5, U2) and the single-pass bulk merge.

Semantics (per table, key compared exactly and null-safely):

* a version *replaces* every current row of each key it carries (a key may
  own many rows; the group is replaced as a whole) and appends its rows;
* a version's *deletes* remove current rows of the listed keys before the
  version's own rows are appended, so a key deleted and re-sent in one
  version survives with the new rows;
* only versions in which the table is present touch it.

Join strategy: the key side is reduced to distinct keys first (a partial
aggregate, so a hot key collapses map-side), then anti-joined with ``<=>``.
No broadcast is forced: AQE turns the join into a broadcast only when the
measured key side is below ``spark.sql.adaptive.autoBroadcastJoinThreshold``
and otherwise keeps a sort-merge join whose skewed partitions it splits.
"""

from __future__ import annotations

import operator
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from regflat.operators.flatten import q

VERSION_COL = "_regflat_v"


# ---------------------------------------------------------------- U2 --------
def merged_schema(frames: Sequence[DataFrame]) -> dict[str, T.DataType]:
    """Name -> type over all frames, first-seen order.  Types that disagree
    widen to string, so a later union never fails at run time under ANSI."""
    out: dict[str, T.DataType] = {}
    for df in frames:
        for f in df.schema.fields:
            if f.name not in out:
                out[f.name] = f.dataType
            elif out[f.name] != f.dataType:
                out[f.name] = T.StringType()
    return out


def conform(df: DataFrame, schema: dict[str, T.DataType]) -> DataFrame:
    """Project ``df`` onto ``schema``: cast mismatches, null for missing."""
    exprs = []
    for name, dtype in schema.items():
        if name in df.columns:
            c = q(name)
            if df.schema[name].dataType != dtype:
                c = c.cast(dtype)
            exprs.append(c.alias(name))
        else:
            exprs.append(F.lit(None).cast(dtype).alias(name))
    return df.select(*exprs)


def align_union(*frames: DataFrame) -> DataFrame:
    """Union-all by name; missing columns become null, clashes widen."""
    frames = [f for f in frames if f is not None]
    schema = merged_schema(frames)
    return reduce(DataFrame.unionByName, [conform(f, schema) for f in frames])


# ---------------------------------------------------------------- J1-J5 -----
def _key_cond(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    return reduce(operator.and_, [left[f"`{k}`"].eqNullSafe(right[f"`{k}`"]) for k in keys])


def key_set(*frames: DataFrame | None, keys: Sequence[str]) -> DataFrame | None:
    """Distinct keys over the given frames (partial aggregate per frame)."""
    parts = [f.select(*[q(k) for k in keys]) for f in frames if f is not None]
    if not parts:
        return None
    return reduce(DataFrame.unionByName, parts).distinct()


def remove_keys(df: DataFrame, keys_df: DataFrame | None, keys: Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose key is not among ``keys_df`` (null-safe).

    No broadcast is forced: AQE decides from the measured size of the keys."""
    if keys_df is None:
        return df
    right = keys_df.select(*[q(k) for k in keys]).distinct()
    return df.join(right, _key_cond(df, right, keys), "left_anti")


Remover = Callable[[DataFrame, "DataFrame | None", Sequence[str]], DataFrame]


def replace_by_key(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``(old minus keys of new) union-all new``."""
    return delete_replace(old, new, None, keys)


def delete_replace(old: DataFrame, new: DataFrame | None, deletes: DataFrame | None,
                   keys: Sequence[str], remove: Remover = remove_keys) -> DataFrame:
    """``((old minus deletes) minus keys of new) union-all new``.

    Both anti-joins are folded into one against the union of the two key
    sets, so the old table is shuffled once (or not at all when AQE measures
    the key set small enough to broadcast).  ``remove`` is the anti-join (see
    ``key_screen`` for one behind a filter).
    """
    doomed = key_set(new, deletes, keys=keys)
    kept = remove(old, doomed, keys)
    return align_union(kept, new) if new is not None else kept


def update_table(current: DataFrame | None, new: DataFrame, keys: Sequence[str],
                 deletes: DataFrame | None = None, helper_columns: Iterable[str] = (),
                 remove: Remover = remove_keys) -> DataFrame:
    """Merge a landed table into the current one, or take it as is."""
    helpers = [c for c in helper_columns]
    new = new.drop(*[c for c in helpers if c in new.columns])
    if current is None:
        return new
    current = current.drop(*[c for c in helpers if c in current.columns])
    return delete_replace(current, new, deletes, keys, remove)


# ---------------------------------------------------------------- fold ------
@dataclass
class TableVersion:
    """One version's contribution to one table.

    ``rows`` is None when the table is absent from the version (then the
    version's deletes do not reach the table either).
    """

    rank: int
    rows: DataFrame | None
    deletes: DataFrame | None = None


def fold_merge(current: DataFrame | None, versions: Sequence[TableVersion], keys: Sequence[str],
               checkpoint_every: int = 8) -> DataFrame | None:
    """L3: apply versions one at a time in rank order (the reference order).

    The lineage is cut with a reliable ``checkpoint()`` (written under
    ``spark.checkpoint.dir``) every ``checkpoint_every`` applied versions,
    so plans stay shallow and a lost executor recomputes from shared files.
    """
    applied = 0
    for v in sorted(versions, key=lambda x: x.rank):
        if v.rows is None:
            continue
        if current is None:
            current = v.rows
        else:
            current = delete_replace(current, v.rows, v.deletes, keys)
        applied += 1
        if checkpoint_every and applied % checkpoint_every == 0:
            current = current.checkpoint(eager=True)
    return current


# ---------------------------------------------------------------- bulk ------
def bulk_merge(current: DataFrame | None, deltas: DataFrame, deletes: DataFrame | None,
               present: DataFrame, keys: Sequence[str], version_col: str = VERSION_COL) -> DataFrame:
    """Single-pass merge of all versions at once; equals :func:`fold_merge`.

    ``deltas``: every landed row of the table, with its version rank in
    ``version_col``.  ``deletes``: keys + ``version_col``.  ``present``: the
    ranks in which the table is present (column ``version_col``).

    A delta row of version v survives iff v is the largest version carrying
    its key and no version d > v in which the table is present deletes the
    key.  A current row survives iff no delta row and no live delete carries
    its key.  So the (large) current table only meets an anti-join against
    the delta key set, broadcast when AQE's measured size allows, else sort-merge;
    the deltas go through one aggregate over ``(key, version)`` pairs
    (map-side combined, so a hot key is reduced before the shuffle) and one
    equi-join back, whose skewed partitions AQE can split.  No window, so no
    key's rows are ever forced into one task.
    """
    kcols = [q(k) for k in keys]
    deltas = deltas.withColumn(version_col, q(version_col).cast("int"))
    parts = [deltas.select(*kcols, q(version_col).alias("_up"), F.lit(None).cast("int").alias("_del"))]
    if deletes is not None:
        # one row per pending version, so it is broadcast: deletes are not shuffled on a few version values
        live_deletes = deletes.join(F.broadcast(present.select(q(version_col)).distinct()), version_col, "left_semi")
        parts.append(live_deletes.select(*kcols, F.lit(None).cast("int").alias("_up"),
                                         q(version_col).cast("int").alias("_del")))
    marks = (reduce(DataFrame.unionByName, parts)
             .groupBy(*kcols)
             .agg(F.max("_up").alias("_mv"), F.max("_del").alias("_dv")))
    r, m = deltas.alias("r"), marks.alias("m")
    cond = reduce(operator.and_, [r[f"`{k}`"].eqNullSafe(m[f"`{k}`"]) for k in keys])
    cond = cond & (r[f"`{version_col}`"] == m["_mv"])
    keep = m["_dv"].isNull() | (m["_dv"] <= r[f"`{version_col}`"])
    survivors = r.join(m, cond, "inner").filter(keep).select(*[r[f"`{c}`"] for c in deltas.columns])
    if current is None:
        return survivors
    kept = remove_keys(current, marks.select(*kcols), keys).withColumn(version_col, F.lit(-1))
    return align_union(kept, survivors)
