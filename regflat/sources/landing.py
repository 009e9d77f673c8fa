"""Landing inventory and version lists.

Landed layout: ``<root>/office=<o>[/schema=<s>]/version=<v>/table=<t>/part-*.parquet``
(one folder per table per version that has rows; the schema level is there for
offices with several schemas).  A version counts as landed once its marker below
``<root>/_complete`` is written, which is the last step of landing it: a crash
before leaves files that the next attempt overwrites.  The inventory is a DataFrame built by the
``binaryFile`` source with only path/size/time selected, so listing never
reads file content.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from regflat.functions.strings import base_name, day_names, padded_numbers

def _part(name: str) -> F.Column:
    return F.regexp_extract("path", f"/{name}=([^/]+)/", 1)


def inventory(spark: SparkSession, root: str, glob: str = "*.parquet") -> DataFrame:
    """One row per landed file with office, version, table and size.

    Layout ``<root>/office=<o>/version=<v>/table=<t>/part-*.parquet``; the
    content column of ``binaryFile`` is never selected, so nothing is read.
    """
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
             .option("pathGlobFilter", glob).load(root.rstrip("/"))
             .select("path", "length", "modificationTime"))
    return files.select(
        "path",
        _part("office").alias("office"),
        F.coalesce(F.nullif(_part("schema"), F.lit("")), F.lit("default")).alias("schema"),
        _part("version").alias("version"),
        _part("table").alias("table"),
        base_name(F.col("path")).alias("file"),
        "length",
        "modificationTime",
    )


def area(office: str, schema: str = "default") -> str:
    """Path level of an office, and of its schema where it has several."""
    return f"office={office}" if schema == "default" else f"office={office}/schema={schema}"


def table_folder(landing: str, office: str, version: str, table: str | None = None, schema: str = "default") -> str:
    base = f"{landing.rstrip('/')}/{area(office, schema)}/version={version}"
    return base if table is None else f"{base}/table={table}"


# payload and schema say where a table's rows are in its files (null: the files are the table)
COMPLETE_SCHEMA = "version string, table string, payload string, schema string"


def mark_complete(spark: SparkSession, landing: str, office: str, version: str, schema: str = "default",
                  tables: Sequence[str] | Mapping[str, tuple[str | None, str | None]] | None = None) -> None:
    """Close the landing of one version: write its marker with the tables it holds.

    ``tables`` are names, or name -> (payload, schema).  Not given, a marker
    that is there stays; without one all tables found below the version count."""
    if tables is None:
        if version in complete_versions(spark, landing, office, schema):
            return
        found = inventory(spark, table_folder(landing, office, version, schema=schema))
        tables = [r["table"] for r in found.select("table").distinct().collect()]
    places = tables if isinstance(tables, Mapping) else dict.fromkeys(tables, (None, None))
    rows = [(version, t, *places[t]) for t in sorted(places)] or [(version, None, None, None)]
    spark.createDataFrame(rows, COMPLETE_SCHEMA).coalesce(1).write.mode("overwrite") \
        .parquet(f"{landing.rstrip('/')}/_complete/{area(office, schema)}/version={version}")


def complete_versions(spark: SparkSession, landing: str, office: str,
                      schema: str = "default") -> dict[str, dict[str, tuple[str | None, str | None]]]:
    """Landed versions and their tables with (payload, schema), from the markers (a few rows per version)."""
    try:
        marks = spark.read.schema(COMPLETE_SCHEMA).option("recursiveFileLookup", "true") \
            .parquet(f"{landing.rstrip('/')}/_complete/{area(office, schema)}").collect()
    except Exception as exc:
        if "PATH_NOT_FOUND" in str(exc) or "does not exist" in str(exc):
            return {}
        raise
    out: dict[str, dict[str, tuple[str | None, str | None]]] = {}
    for r in marks:
        found = out.setdefault(r["version"], {})
        if r["table"] is not None:
            found[r["table"]] = (r["payload"], r["schema"])
    return out


def landed_tables(inv: DataFrame, exclude: Sequence[str] = ("delete",)) -> DataFrame:
    """distinct (office, version, table) without the delete table."""
    return (inv.filter(~F.col("table").isin(*exclude))
            .select("office", "version", "table").distinct())


def daily_versions(start: Column, end: Column, fmt: str = "yyMMdd") -> Column:
    """Daily version names in [start, end)."""
    return day_names(start, end, fmt)


def historical_versions(n: Column, width: int = 2) -> Column:
    """Historical series ``01``..``n``."""
    return padded_numbers(n, width)


def order_versions(versions: DataFrame, order: Sequence[Column | str]) -> DataFrame:
    """Attach an integer ``rank`` following ``order``.

    The input is a version listing (one row per version, at most tens of
    thousands of rows, never data rows), so a global row_number is cheap.
    """
    w = Window.orderBy(*order)
    return versions.withColumn("rank", F.row_number().over(w))


def unlanded(expected: DataFrame, landed: DataFrame, on: Sequence[str]) -> DataFrame:
    """F8: versions listed but not landed yet."""
    return expected.join(landed.select(*on).distinct(), list(on), "left_anti")
