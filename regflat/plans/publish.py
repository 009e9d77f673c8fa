"""Writing and publishing tables.

File sizing is left to Spark: a ``rebalance`` hint plus AQE's advisory
partition size gives files near the target size whatever the table size
(one file for a small table, N files of ~target bytes for a large one),
instead of the published code's partition-count thresholds.  No write is
ever funnelled through a single task for a table larger than the target.
"""

from __future__ import annotations

import contextlib
import json
import math
from collections.abc import Iterator, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

TARGET_FILE_BYTES = 512 * 1024 * 1024
OPEN_FILES = 4  # folders that a task writes at once; with more it sorts its rows


@contextlib.contextmanager
def session_conf(spark: SparkSession, conf: Mapping[str, str]) -> Iterator[None]:
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def _sized_write(df: DataFrame, path: str, target_bytes: int, mode: str, int96: bool,
                 partition_by: tuple[str, ...] = ()) -> None:
    conf = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_bytes),
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    }
    if int96:
        conf["spark.sql.parquet.outputTimestampType"] = "INT96"
    if partition_by:
        # a task holds few folders: it keeps a file open for each instead of sorting its rows by folder
        conf["spark.sql.maxConcurrentOutputFileWriters"] = str(OPEN_FILES)
    with session_conf(df.sparkSession, conf):
        # rebalance by the partition columns keeps one writer per folder
        # (sized by AQE), instead of every task writing into every folder
        hinted = df.hint("rebalance", *partition_by) if partition_by else df.hint("rebalance")
        writer = hinted.write.mode(mode).option("compression", "snappy")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(path)


def save_table(df: DataFrame, path: str, target_bytes: int = TARGET_FILE_BYTES,
               mode: str = "overwrite", int96: bool = False, rebalance: bool = True) -> None:
    """Write a current table with files near ``target_bytes``.

    ``rebalance=False`` writes the partitions as they come: right for a
    table produced map-side from large inputs (a merged snapshot keeps the
    input splits of the current table), where a rebalance would shuffle the
    whole table only to size files."""
    if rebalance:
        _sized_write(df, path, target_bytes, mode, int96)
        return
    conf = {"spark.sql.parquet.outputTimestampType": "INT96"} if int96 else {}
    with session_conf(df.sparkSession, conf):
        df.write.mode(mode).option("compression", "snappy").parquet(path)


def stored_bytes(spark: SparkSession, path: str | list[str]) -> int:
    """Bytes of the Parquet files below ``path`` (a listing, no data read)."""
    paths = [path] if isinstance(path, str) else list(path)
    if not paths:
        return 0
    size = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
            .option("pathGlobFilter", "*.parquet").load(paths).agg(F.sum("length")).first()[0])
    return int(size or 0)


def _file_system(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def remove_folder(spark: SparkSession, path: str) -> None:
    fs, target = _file_system(spark, path)
    fs.delete(target, True)


def swap_folder(spark: SparkSession, new: str, live: str) -> None:
    """Put a folder that is written in whole in the place of the live one, by renames.

    Until then readers see the old table; a failure while the new one is
    written leaves it untouched.  A crash between the two renames is mended by
    the next swap, which finds the old table beside the live name."""
    fs, target = _file_system(spark, live)
    path = spark._jvm.org.apache.hadoop.fs.Path
    old = path(f"{live}._old")
    if fs.exists(old) and not fs.exists(target):
        fs.rename(old, target)
    fs.delete(old, True)
    if fs.exists(target):
        fs.rename(target, old)
    fs.mkdirs(target.getParent())
    if not fs.rename(path(new), target):
        raise OSError(f"cannot rename {new} to {live}")
    fs.delete(old, True)


def compact_files(spark: SparkSession, src: str, dst: str, target_bytes: int = TARGET_FILE_BYTES,
                  int96: bool = False) -> None:
    """W4 for a stored table without a shuffle: ``coalesce(n)`` with
    n = stored bytes / target concatenates neighbouring files into ~target
    sized ones (one file below the target).  Each of the n tasks streams its
    share of the files; nothing is exchanged between executors."""
    n = max(1, math.ceil(stored_bytes(spark, src) / target_bytes))
    conf = {"spark.sql.parquet.outputTimestampType": "INT96"} if int96 else {}
    with session_conf(spark, conf):
        (spark.read.parquet(src).coalesce(n).write.mode("overwrite")
         .option("compression", "snappy").parquet(f"{dst}._new"))
    swap_folder(spark, f"{dst}._new", dst)


def compact_table(df: DataFrame, path: str, target_bytes: int = TARGET_FILE_BYTES,
                  int96: bool = False, partition_by: tuple[str, ...] = ()) -> None:
    """Publish compacted; a table below the target becomes one file
    (one per partition folder when ``partition_by`` is given)."""
    _sized_write(df, path, target_bytes, "overwrite", int96, partition_by)


@dataclass(frozen=True)
class SavedTable:
    """One table of a family: its folder, and where its rows are in it.

    ``payload`` is the struct column that holds the row, ``schema`` its type as
    JSON; both are None for a folder of plain files."""

    path: str
    payload: str | None = None
    schema: str | None = None

    def read(self, spark: SparkSession) -> DataFrame:
        if self.payload is None:
            return spark.read.parquet(self.path)
        row = T.StructType.fromJson(json.loads(self.schema))
        fs, target = _file_system(spark, self.path)
        if not fs.exists(target):  # a table without rows has no folder
            return spark.createDataFrame([], row)
        return spark.read.schema(T.StructType([T.StructField(self.payload, row)])).parquet(self.path).select(f"{self.payload}.*")


def save_family(tables: Mapping[str, DataFrame], folder: str) -> dict[str, SavedTable]:
    """Write every table of a version's family below ``folder`` in one job.

    The tables become one stream of tagged rows: the name of the table, and one
    struct column per table that is null but in the rows of its own, so equal
    column names with unlike types do not meet.  One write, partitioned by the
    name, puts each row in its folder ``table=<name>``; what the folder holds
    before goes.  Rows stay in the partition that made them (a task writes one
    table, so no sort by folder is needed): the fixed cost of a version is one
    job, however many tables it has.
    """
    names = sorted(tables)
    if not names:
        return {}
    payload = {name: f"t{i}" for i, name in enumerate(names)}
    types = {name: tables[name].schema for name in names}

    def tagged(name: str) -> DataFrame:
        row = F.struct(*[f"`{c}`" for c in types[name].names])
        return tables[name].select(F.lit(name).alias("table"), *[
            (row if other == name else F.lit(None).cast(types[other])).alias(payload[other]) for other in names])

    rows = [tagged(name) for name in names]
    while len(rows) > 1:  # pairwise, so that the plan is not as deep as the family is long
        rows = [rows[i].union(rows[i + 1]) if i + 1 < len(rows) else rows[i] for i in range(0, len(rows), 2)]
    spark = rows[0].sparkSession
    with session_conf(spark, {"spark.sql.maxConcurrentOutputFileWriters": str(OPEN_FILES)}):
        # static: the whole folder is replaced, tables that are not written again go too
        rows[0].write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("table").parquet(folder)
    return {name: SavedTable(f"{folder}/table={name}", payload[name], types[name].json()) for name in names}


def publish_all(spark: SparkSession, tables: Mapping[str, DataFrame], folder: str,
                target_bytes: int = TARGET_FILE_BYTES, int96: bool = True) -> dict[str, str]:
    """W4/W5 for every table; INT96 timestamps as in the published files."""
    out = {}
    for name, df in tables.items():
        path = f"{folder}/{name}.parquet"  # one Parquet output per table, as published
        compact_table(df, path, target_bytes, int96=int96)
        out[name] = path
    return out
