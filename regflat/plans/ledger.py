"""Version ledger.

The ledger is a Parquet table appended once per committed version, one row
per table the version touched.  The append is the commit point: a version
whose ledger rows are missing is invisible, whatever files it left behind.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

# kind: "snapshot" (a full table), "delta" (one version's rows of a table,
# merge-on-read) or "deletes" (one version's delete keys); null = snapshot.
LEDGER_SCHEMA = ("office string, schema string, version string, rank int, "
                 "table string, snapshot string, committed_at timestamp, kind string")


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    try:
        return spark.read.schema(LEDGER_SCHEMA).parquet(path)
    except Exception as exc:  # no ledger yet
        if "PATH_NOT_FOUND" in str(exc) or "does not exist" in str(exc):
            return spark.createDataFrame([], LEDGER_SCHEMA)
        raise


def append_ledger(spark: SparkSession, path: str, office: str, schema: str,
                  entries: Sequence[tuple[str, int, dict[str, str]]]) -> None:
    """Commit versions by appending one row per touched table.

    ``entries`` is ``[(version, rank, {table: path})]`` where a path may be
    given as ``(kind, path)``; all of them are committed by one append, so a
    multi-version commit is all or nothing.  An empty version still advances
    the ledger (one row with no table).
    """
    now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    rows = []
    for version, rank, tables in entries:
        got = []
        for t, target in sorted(tables.items()):
            kind, location = target if isinstance(target, tuple) else ("snapshot", target)
            got.append((office, schema, version, int(rank), t, location, now, kind))
        rows.extend(got or [(office, schema, version, int(rank), None, None, now, None)])
    spark.createDataFrame(rows, LEDGER_SCHEMA).coalesce(1).write.mode("append").parquet(path)


def latest(ledger: DataFrame, by: Sequence[str] = ("office", "schema")) -> DataFrame:
    """Latest committed version per group (``max_by`` on rank)."""
    return ledger.groupBy(*by).agg(F.max_by("version", "rank").alias("latest"),
                                   F.max("rank").alias("latest_rank"))


def pending(versions: DataFrame, ledger: DataFrame, by: Sequence[str] = ("office", "schema")) -> DataFrame:
    """O3 as table work: every version ranked after the group's latest commit.

    ``versions`` has ``by`` + ``version`` + ``rank``.  A group without
    ledger rows has all its versions pending.
    """
    last = latest(ledger, by).select(*by, "latest_rank")
    return (versions.join(last, list(by), "left")
            .filter(F.col("latest_rank").isNull() | (F.col("rank") > F.col("latest_rank")))
            .drop("latest_rank"))


def next_version(versions: DataFrame, ledger: DataFrame, by: Sequence[str] = ("office", "schema")) -> DataFrame:
    """O3: the single next version per group (none when up to date)."""
    from pyspark.sql import Window
    p = pending(versions, ledger, by)
    w = Window.partitionBy(*by).orderBy("rank")
    return p.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")
