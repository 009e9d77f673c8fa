"""Catalog of published files and their columns.

Schemas come from Parquet footers only (no job over data).  The output has
one row per (folder, file, column): metadata, bounded by the number of
columns published.

``column_statistics`` adds rows, nulls and bounds per column.  Spark answers
such aggregates from the footers alone (aggregate push-down of its Parquet
source), by tasks over the files: no column is read.
"""

from __future__ import annotations

import re
from collections.abc import Collection, Mapping

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from regflat.operators.flatten import q
from regflat.plans.publish import session_conf

CATALOG_SCHEMA = "folder string, file string, position int, column string"


def table_columns(spark: SparkSession, path: str) -> list[str]:
    """Column names of a Parquet table, read from the footer."""
    return spark.read.parquet(path).schema.fieldNames()


def catalog(spark: SparkSession, tables: Mapping[str, Mapping[str, str]]) -> DataFrame:
    """``{folder: {file: path}}`` -> rows ``(folder, file, position, column)``."""
    rows = []
    for folder in sorted(tables):
        for file in sorted(tables[folder]):
            for i, col in enumerate(table_columns(spark, tables[folder][file]), start=1):
                rows.append((folder, file, i, col))
    return spark.createDataFrame(rows, CATALOG_SCHEMA)


def published_tables(spark: SparkSession, folder: str) -> dict[str, str]:
    """Tables (Parquet folders or files) directly below ``folder``, found by
    listing part files with the ``binaryFile`` source (content never read)."""
    root = folder.rstrip("/")
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
             .option("pathGlobFilter", "*.parquet").load(root).select("path"))
    rel = F.regexp_extract("path", r"^(?:file:)?" + re.escape(root.removeprefix("file:")) + r"/([^/]+)", 1)
    names = sorted(r[0] for r in files.select(rel.alias("t")).distinct().collect() if r[0])
    return {n.removesuffix(".parquet"): f"{root}/{n}" for n in names}


def catalog_folders(spark: SparkSession, folders: Mapping[str, str]) -> DataFrame:
    """W8 over published folders: ``{label: folder path}`` -> catalog rows."""
    return catalog(spark, {label: published_tables(spark, path) for label, path in folders.items()})


STATISTICS_SCHEMA = ("file string, column string, n_rows bigint, n_nulls bigint, low_long bigint, high_long bigint, "
                     "low_double double, high_double double, low_date date, high_date date")
_BOUNDED = {T.ByteType: "long", T.ShortType: "long", T.IntegerType: "long", T.LongType: "long",
            T.FloatType: "double", T.DoubleType: "double", T.DateType: "date"}
# read Parquet through the source that takes aggregates, and let it take them
FROM_FOOTERS = {"spark.sql.sources.useV1SourceList": "avro,csv,json,kafka,orc,text", "spark.sql.parquet.aggregatePushdown": "true"}


def statistics_plan(spark: SparkSession, path: str, counts: bool = True, bounds: Collection[str] | None = None) -> DataFrame:
    """One row of counts, and bounds of the columns named (all, if not given); footers answer it under ``FROM_FOOTERS``."""
    df = spark.read.parquet(path)
    aggs = [F.count(F.lit(1)).alias("n")] if counts else []
    for i, f in enumerate(df.schema.fields):
        if counts and not isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType, T.VariantType)):
            aggs.append(F.count(q(f.name)).alias(f"n{i}"))  # of a nested column footers count the leaves only
        if type(f.dataType) in _BOUNDED and (bounds is None or f.name in bounds):
            value = q(f.name)
            if not counts and _BOUNDED[type(f.dataType)] == "double":
                value = F.when(~F.isnan(value), value)
            aggs += [F.min(value).alias(f"low{i}"), F.max(value).alias(f"high{i}")]
    return df.agg(*aggs)


def column_statistics(spark: SparkSession, tables: Mapping[str, str]) -> DataFrame:
    """``{file: path}`` -> one row per (file, column) with rows, nulls and the least and greatest value.

    Bounds are those of whole numbers, floating numbers (NaN does not count,
    zero has no sign) and dates; they are null for other types, for which
    footers may hold none or cut ones, and for columns without values.  Nulls
    of nested columns are null (unknown).  Counts always come from footers; a
    table with a file whose footer lacks a bound (a column without values
    there, or with NaN) has its bounds taken from the columns that need them.
    """
    rows = []
    for file in sorted(tables):
        path = tables[file]
        fields = spark.read.parquet(path).schema.fields
        bounded = [f.name for f in fields if type(f.dataType) in _BOUNDED]
        with session_conf(spark, FROM_FOOTERS):
            try:
                got = statistics_plan(spark, path).first().asDict()
                bounded = []
            except (PySparkException, Py4JJavaError) as exc:
                if "No min/max found" not in str(exc):
                    raise
                got = statistics_plan(spark, path, bounds=()).first().asDict()
        if bounded:
            bounded = [f.name for i, f in enumerate(fields) if f.name in bounded and got[f"n{i}"]]
        if bounded:
            got |= statistics_plan(spark, path, counts=False, bounds=bounded).first().asDict()
        for i, f in enumerate(fields):
            kind = _BOUNDED.get(type(f.dataType))
            ends = [got.get(f"{end}{i}") if kind == k else None for k in ("long", "double", "date") for end in ("low", "high")]
            ends = [v + 0.0 if isinstance(v, float) else v for v in ends]
            n = got["n"] or 0  # no footer with rows, no count
            nulls = n - (got[f"n{i}"] or 0) if f"n{i}" in got else None
            rows.append((file, f.name, n, nulls, *ends))
    return spark.createDataFrame(rows, STATISTICS_SCHEMA)
