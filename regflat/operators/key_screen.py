"""Anti-join behind a runtime filter of the keys.

The distinct keys of a version become a blocked Bloom filter held as a table:
one row per non-empty 64-bit block, ``BITS`` bits of one block per key,
aggregated map-side before its small shuffle.  The current table probes it in
place; rows that the filter stops carry none of the keys and go straight to
the result, without an exchange.  Only possible hits, the rows of the keys and
a few false positives, enter the exact null-safe anti-join.

The filter has at most ``MAX_BLOCKS`` rows, which bounds what is broadcast.
With more than ``MAX_BLOCKS * 64 / BITS_PER_KEY`` keys it holds fewer bits a
key and stops fewer rows; the result is the same.

The current table is scanned twice (rows stopped, rows passed) where a sort
merge join would shuffle it once.  Keys whose types differ on the two sides,
or that are floating or nested, take the plain anti-join: equal values of
these need not have equal hashes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from regflat.operators.flatten import q
from regflat.operators.merge import remove_keys

BITS_PER_KEY = 16
BITS = 5                  # set per key
MAX_BLOCKS = 1 << 20      # rows of two longs that are broadcast: 16 MB of data
_PLAIN = (T.FloatType, T.DoubleType, T.ArrayType, T.MapType, T.StructType)


def _block(keys: Sequence[str], blocks: int) -> Column:
    return F.pmod(F.xxhash64(*[q(k) for k in keys]), F.lit(blocks))


def _word(keys: Sequence[str]) -> Column:
    # a hash of its own: the block must say nothing about the bits
    h = F.xxhash64(F.lit("bits"), *[q(k) for k in keys])
    bits = [F.call_function("shiftleft", F.lit(1).cast("long"),
                            F.shiftrightunsigned(h, 6 * i).bitwiseAND(F.lit(63)).cast("int")) for i in range(BITS)]
    out = bits[0]
    for b in bits[1:]:
        out = out.bitwiseOR(b)
    return out


def screened(df: DataFrame, keys_df: DataFrame, keys: Sequence[str], n_keys: int) -> tuple[DataFrame, DataFrame]:
    """Rows of ``df`` that may carry one of the keys, and rows that carry none for sure."""
    blocks = min(MAX_BLOCKS, max(1, -(-n_keys * BITS_PER_KEY // 64)))
    table = keys_df.select(_block(keys, blocks).alias("_block"), _word(keys).alias("_bits")) \
        .groupBy("_block").agg(F.bit_or("_bits").alias("_set"))
    probed = df.withColumn("_probe", _block(keys, blocks)) \
        .join(F.broadcast(table), F.col("_probe") == F.col("_block"), "left")
    passes = F.coalesce(F.col("_set").bitwiseAND(_word(keys)) == _word(keys), F.lit(False))
    return tuple(probed.where(x).select(*[q(c) for c in df.columns]) for x in (passes, ~passes))


def remove_keys_screened(df: DataFrame, keys_df: DataFrame | None, keys: Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose key is not among ``keys_df`` (null-safe): what ``remove_keys`` gives."""
    if keys_df is None:
        return df
    kinds = [df.schema[k].dataType for k in keys]
    if kinds != [keys_df.schema[k].dataType for k in keys] or any(isinstance(x, _PLAIN) for x in kinds):
        return remove_keys(df, keys_df, keys)
    distinct = keys_df.select(*[q(k) for k in keys]).distinct()
    possible, clear = screened(df, distinct, keys, distinct.count())
    return remove_keys(possible, distinct, keys).unionByName(clear)
