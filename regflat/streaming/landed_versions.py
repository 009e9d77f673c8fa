"""Apply landed versions as they arrive, with Structured Streaming.

Landing a version ends with one marker row ``(office, schema, version, rank)``
appended to ``<landing>/_landed``.  A file stream over that folder triggers
``foreachBatch``; the batch only signals that something landed.  The
version *order* never comes from arrival order (file streams order by
modification time): each trigger reads the markers of its office and schema
above the ledger's latest rank and applies the contiguous run right after it,
so a version that lands early waits for its predecessor, and what reaches the
driver is one row per version not applied yet.  The schemas of one office are
streams of their own with one marker folder: their ranks do not meet.  The ledger makes replays after
a restart no-ops, which gives exactly-once effects on top of the stream's
at-least-once batches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from regflat.plans.offices import OfficeSpec
from regflat.plans.snapshot import SnapshotStore
from regflat.plans.updates import apply_in_order
from regflat.sources.landing import mark_complete

# markers written without a schema belong to the default one
MARKER_SCHEMA = "office string, schema string, version string, rank int"


def marker_path(landing: str) -> str:
    return f"{landing.rstrip('/')}/_landed"


def mark_landed(spark: SparkSession, landing: str, office: str, version: str, rank: int,
                schema: str = "default") -> None:
    """Close the landing of one version and append the marker that wakes the stream."""
    mark_complete(spark, landing, office, version, schema)
    (spark.createDataFrame([(office, schema, version, int(rank))], MARKER_SCHEMA)
     .coalesce(1).write.mode("append").parquet(marker_path(landing)))


def contiguous_after(markers: DataFrame, latest: int | None) -> list[tuple[str, int]]:
    """Versions whose ranks continue the ledger without a gap."""
    rows = markers.where(F.col("rank") > (latest or 0)).select("version", "rank").distinct().collect()
    ranks = {int(r["rank"]): r["version"] for r in rows}
    if len(ranks) < len(rows):
        raise ValueError("two landed versions share a rank")
    out, nxt = [], (latest or 0) + 1
    while nxt in ranks:
        out.append((ranks[nxt], nxt))
        nxt += 1
    return out


def markers_of(markers: DataFrame, office: str, schema: str = "default") -> DataFrame:
    """The markers of one office and schema."""
    return markers.filter((F.col("office") == office) & (F.coalesce("schema", F.lit("default")) == schema))


def start(spark: SparkSession, spec: OfficeSpec, landing: str, store: SnapshotStore,
          checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Start the stream; with ``available_now`` it drains what landed and stops."""
    schema = spec.schemas[0]
    if store.schema != schema:
        raise ValueError(f"the store is of schema {store.schema!r}, the stream of {schema!r}")
    stream = spark.readStream.schema(MARKER_SCHEMA).parquet(marker_path(landing))

    def on_batch(batch: DataFrame, epoch_id: int) -> None:
        if markers_of(batch, spec.office, schema).isEmpty():
            return
        markers = spark.read.schema(MARKER_SCHEMA).parquet(marker_path(landing))
        todo = contiguous_after(markers_of(markers, spec.office, schema), store.latest_rank())
        if todo:
            apply_in_order(store, spec, landing, todo)

    writer = stream.writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
