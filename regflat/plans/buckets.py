"""Current tables bucketed by merge key (J3, J4, L3 without an exchange of the current table).

A table folder holds ``rows`` (Parquet files bucketed and sorted by a key
column), ``hot`` (rows of keys too frequent for one bucket, spread over many
files) and ``layout`` (one row: keys, bucket count, schema), which is written
last: a folder without it is no table.  The folder carries its own layout, so
no catalog has to outlive a session: reading declares the files as a bucketed
table under a name of its own and drops that name again.

A merge deals the distinct keys of a version (its rows and its deletes) to the
same buckets and anti-joins bucket with bucket: the current table, which is
most of the data, goes into no exchange and is written as it was read, one
task a bucket; only the version's own rows are shuffled.  Between frames of
other layouts the null-safe join of ``operators.merge`` stays.

The key column is the text of the merge keys, null and empty told apart, so
that one plain equality joins them (a null-safe comparison would hide the
bucketing from the planner).  Keys of floating or binary type are refused.

Hot keys: a key with more than ``rows / buckets`` rows of one write (and over
``MIN_HOT``) lives in ``hot``; fewer than ``buckets`` keys can.  A key may have rows in both places,
and a merge removes it from both.
"""

from __future__ import annotations

import json
import math
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from regflat.operators.flatten import q
from regflat.operators.merge import conform, key_set, merged_schema, remove_keys
from regflat.plans.publish import stored_bytes

KEY = "_regflat_key"
MIN_HOT = 10_000  # rows of one key that any task can take
BUCKET_BYTES = 32 * 1024 * 1024  # of Parquet; the rows of a bucket are several times that in a shuffle
MIN_BUCKETS = 8
_NO_KEYS = (T.FloatType, T.DoubleType, T.BinaryType, T.ArrayType, T.MapType, T.StructType)


def key_text(df: DataFrame, keys: Sequence[str]) -> Column:
    """The merge keys of a row as one text that is never null and differs where any key does."""
    for k in keys:
        if isinstance(df.schema[k].dataType, _NO_KEYS):
            raise TypeError(f"key {k!r} of type {df.schema[k].dataType.simpleString()} has no exact text")
    # each key with its length ahead, so that the ends of keys need no mark
    parts = [q(k).cast("string") for k in keys]
    return F.concat(*[F.coalesce(F.concat(F.char_length(p), F.lit(":"), p), F.lit("-")) for p in parts])


def _name() -> str:
    return f"regflat_{uuid.uuid4().hex}"


@contextmanager
def _declared(spark: SparkSession, path: str, schema: T.StructType, buckets: int) -> Iterator[str]:
    """A name under which the bucketed files of ``path`` are a table while the block runs."""
    name = _name()
    columns = spark.createDataFrame([], schema)._jdf.schema().toDDL()
    place = path.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (`{KEY}`) SORTED BY (`{KEY}`) "
              f"INTO {int(buckets)} BUCKETS LOCATION '{place}'")
    try:
        yield name
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")  # an external table: its files stay


class BucketedTable:
    """A bucketed table folder as it was committed."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        row = spark.read.parquet(f"{self.path}/layout").first()
        self.keys, self.buckets = tuple(row["keys"]), int(row["buckets"])
        self._schema = T.StructType.fromJson(json.loads(row["schema"]))

    def dealt(self) -> DataFrame:
        """The rows in buckets, with their key column; partitioned by it as far as the planner is concerned."""
        with _declared(self.spark, f"{self.path}/rows", self._schema, self.buckets) as name:
            return self.spark.table(name)

    def hot(self) -> DataFrame:
        """The rows of frequent keys, with their key column."""
        return self.spark.read.schema(self._schema).parquet(f"{self.path}/hot")

    def rows(self) -> DataFrame:
        """All rows of the table."""
        return self.dealt().unionByName(self.hot()).drop(KEY)


def _split(df: DataFrame, buckets: int) -> tuple[DataFrame, DataFrame]:
    """Rows for buckets and rows of hot keys (more than ``rows / buckets`` of them, so fewer keys than buckets)."""
    share = df.agg(F.count(F.lit(1)) / F.lit(buckets)).scalar()  # scalar subquery, planned by Spark
    # one count per key, combined before the shuffle; fewer than `buckets` keys are left to be broadcast
    hot = df.groupBy(KEY).agg(F.count(F.lit(1)).alias("_n")) \
        .where((F.col("_n") > MIN_HOT) & (F.col("_n") > share)).select(KEY)
    return (df.join(F.broadcast(hot), KEY, "left_anti").select(*df.columns),
            df.join(F.broadcast(hot), KEY, "left_semi").select(*df.columns))


def _write(spark: SparkSession, path: str, keys: Sequence[str], buckets: int, schema: T.StructType,
           kept: DataFrame | None, kept_hot: DataFrame | None, new: DataFrame) -> BucketedTable:
    path = path.rstrip("/")
    fresh, fresh_hot = _split(new, buckets)
    parts = ([kept] if kept is not None else []) + [fresh.repartition(buckets, KEY)]
    name = _name()
    try:
        for i, part in enumerate(parts):
            part.write.format("parquet").option("compression", "snappy").option("path", f"{path}/rows") \
                .bucketBy(buckets, KEY).sortBy(KEY).mode("append" if i else "errorifexists").saveAsTable(name)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    hot = fresh_hot if kept_hot is None else kept_hot.unionByName(fresh_hot)
    hot.write.option("compression", "snappy").parquet(f"{path}/hot")
    spark.createDataFrame([(list(keys), buckets, schema.json())], "keys array<string>, buckets int, schema string") \
        .coalesce(1).write.parquet(f"{path}/layout")
    return BucketedTable(spark, path)


def bucket_count(spark: SparkSession, path: str, bucket_bytes: int = BUCKET_BYTES) -> int:
    """Buckets for a table of the size of the Parquet files below ``path``."""
    return max(MIN_BUCKETS, math.ceil(stored_bytes(spark, path) / bucket_bytes))


def write_bucketed(df: DataFrame, path: str, keys: Sequence[str], buckets: int) -> BucketedTable:
    """Write ``df`` as a new bucketed table: the one time that all its rows are shuffled."""
    marked = df.withColumn(KEY, key_text(df, keys))
    return _write(df.sparkSession, path, keys, buckets, marked.schema, None, None, marked)


def merged(table: BucketedTable, new: DataFrame, deletes: DataFrame | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """J4 on a bucketed table: rows kept in buckets, hot rows kept, new rows; all of one schema, with the key column."""
    def mark(df: DataFrame) -> DataFrame:
        return df.withColumn(KEY, key_text(df, table.keys))

    new = mark(new)
    # the keys, not the rows, of the version meet the current table: distinct first, then dealt to its buckets
    doomed = key_set(new, None if deletes is None else mark(deletes), keys=[KEY])
    dealt, hot = table.dealt(), table.hot()
    schema = merged_schema([dealt, new])
    kept = dealt.join(doomed.repartition(table.buckets, KEY), KEY, "left_anti")
    kept_hot = remove_keys(hot, doomed, [KEY])
    return conform(kept, schema), conform(kept_hot, schema), conform(new, schema)


def merge_bucketed(table: BucketedTable, path: str, new: DataFrame, deletes: DataFrame | None = None) -> BucketedTable:
    """The table after one version, as a new folder with the same buckets."""
    kept, kept_hot, fresh = merged(table, new, deletes)
    return _write(table.spark, path, table.keys, table.buckets, fresh.schema, kept, kept_hot, fresh)
