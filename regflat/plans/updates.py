"""Incremental load: land versions, apply them in order or in one pass,
publish (L1, L3, L4, L6).

Landing layout: see ``regflat.sources.landing``.  Version order is explicit (a ``rank`` from the version listing), never the
file-system or stream arrival order.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from regflat.functions.types import bad_value_flags, flagged, split_flags
from regflat.operators.flatten import q
from regflat.operators.merge import VERSION_COL, align_union, bulk_merge
from regflat.plans.offices import OfficeSpec, normalise, prepare_new_rows
from regflat.plans.publish import SavedTable, TARGET_FILE_BYTES, compact_files, remove_folder, save_family, session_conf
from regflat.plans.snapshot import SnapshotStore
from regflat.session import work_dir
from regflat.sources.archive import expand_archives, write_records_as_xml
from regflat.sources.landing import area, complete_versions, mark_complete, table_folder
from regflat.sources.xml_records import load_schema, read_records, record_ranges, record_schema, store_schema

PUBLISHED_AT_ONCE = 4  # tables


def land_version(spark: SparkSession, spec: OfficeSpec, xml_path: str, landing: str,
                 version: str, schema=None) -> dict[str, str]:
    """L1: XML records of one version -> its table family as Parquet.

    The records are parsed once, into packed files that go afterwards; every
    table is a projection of them, and one job writes them all and counts the
    values that the type rules null.
    Without a given schema the version's schema is inferred once (a full
    pass) and stored beside the landing, so a retry skips the inference.
    The completion marker is written last.
    """
    where = area(spec.office, spec.schemas[0])
    schema_path = f"{landing.rstrip('/')}/_schemas/{where}/version={version}"
    if schema is None:
        schema = load_schema(spark, schema_path)
    written: dict[str, SavedTable] = {}
    ranges = record_ranges(spark, xml_path, spec.row_tag).persist()  # found once, read for the schema and for the rows
    try:
        if schema is None:
            schema = record_schema(spark, xml_path, spec.row_tag, ranges)
            store_schema(spark, schema_path, schema)
        if schema.fields:  # an empty version lands no table; applying it still advances the ledger
            written = _land_records(spark, spec, read_records(spark, xml_path, spec.row_tag, schema, ranges=ranges), landing, version)
    finally:
        ranges.unpersist()
    mark_complete(spark, landing, spec.office, version, spec.schemas[0],
                  {name: (saved.payload, saved.schema) for name, saved in written.items()})
    return {name: saved.path for name, saved in written.items()}


def _land_records(spark: SparkSession, spec: OfficeSpec, records: DataFrame, landing: str, version: str) -> dict[str, SavedTable]:
    # a cache would hold them many times as large, in the executors' memory and on their disks
    parsed = work_dir(spark, f"parsed-{spec.office}")
    try:
        records.write.parquet(parsed)
        records = spark.read.schema(records.schema).parquet(parsed)
        with bad_value_flags():
            tables, counts = observe_quality(normalise(spec, records))
        written = save_family(tables, table_folder(landing, spec.office, version, schema=spec.schemas[0]))
        if spec.type_rules:
            write_quality(spark, counts, quality_path(landing, spec.office, version, spec.schemas[0]))
    finally:
        remove_folder(spark, parsed)
    return written


def quality_path(landing: str, office: str, version: str, schema: str = "default") -> str:
    return f"{landing.rstrip('/')}/_quality/{area(office, schema)}/version={version}"


def observe_quality(tables: Mapping[str, DataFrame]) -> tuple[dict[str, DataFrame], dict[str, tuple[list[str], Observation]]]:
    """Tables without the flags of ``bad_value_flags``, and table -> (flags, counts to come).

    The counts are taken by the job that writes the tables: rows of the landed
    table (after D1) whose value was bad.  The observation sits above a table's
    last shuffle, so it runs in the tasks that write; Spark counts such a task
    once, also when an executor is lost and the shuffle below is repeated."""
    out, counts = {}, {}
    for name, df in tables.items():
        columns, flags = split_flags(df)
        if flags:
            seen = Observation()
            df = df.observe(seen, *[F.count_if(q(c)).alias(f"n{i}") for i, c in enumerate(flags)])
            counts[name] = (flags, seen)
            df = df.select(*[q(c) for c in columns])
        out[name] = df
    return out, counts


def write_quality(spark: SparkSession, counts: Mapping[str, tuple[list[str], Observation]], path: str) -> None:
    """K5-K9 quality table of one version: ``(table, column, rule, n_bad)``, from the counts of its landing."""
    rows = [(name, *flagged(flag), int(seen.get[f"n{i}"])) for name, (flags, seen) in sorted(counts.items())
            for i, flag in enumerate(flags)]
    spark.createDataFrame(rows, "table string, column string, rule string, n_bad bigint") \
        .coalesce(1).write.mode("overwrite").parquet(path)


def land_archives(spark: SparkSession, spec: OfficeSpec, zip_root: str, landing: str, version: str,
                  schema=None, member_suffix: str = ".xml") -> dict[str, str]:
    """L1/L2 for zipped versions: expand every member into record rows (one
    task per member), land them as plain XML text (splittable from then on)
    and normalise that like any landed XML."""
    xml_dir = work_dir(spark, f"expanded-{spec.office}-{version}")
    write_records_as_xml(expand_archives(spark, zip_root, spec.row_tag, member_suffix), xml_dir)
    return land_version(spark, spec, xml_dir, landing, version, schema)


class LateVersion(ValueError):
    """A version was listed before one that is already merged."""


def pending_versions(store: SnapshotStore, versions: Sequence[tuple[str, int]]) -> list[tuple[str, int]]:
    """O3: the listed versions that the ledger does not have, in order, with the rank each will be committed under.

    What is merged is decided by version *name*: ranks come from the current
    listing and shift when it changes.  A version that sorts before the latest
    merged one can no longer be merged in order, so it raises.
    """
    done = store.committed_versions()
    todo = sorted(((n, r) for n, r in versions if n not in done), key=lambda x: x[1])
    merged = [r for n, r in versions if n in done]
    late = [n for n, r in todo if merged and r < max(merged)]
    if late:
        raise LateVersion(f"{', '.join(late)}: listed before a version that is already merged")
    out, last = [], max(done.values(), default=0)
    for n, r in todo:
        last = max(r, last + 1)
        out.append((n, last))
    return out


def apply_in_order(store: SnapshotStore, spec: OfficeSpec, landing: str,
                   versions: Sequence[tuple[str, int]], cascade: bool = False) -> bool:
    """L3/L4: fold the versions that the ledger does not have, one commit each.

    ``versions`` is the ordered listing ``[(name, rank)]`` (for GB the rank
    follows ``(phase, name)``).  A failed version raises with the previous
    snapshot intact and the ledger at the last good version.
    """
    spark = store.spark
    landed = landed_families(spark, landing, spec.office, spec.schemas[0])
    updated = False
    for name, rank in pending_versions(store, versions):
        # an empty or missing version merges nothing but still advances
        tables = read_family(spark, landed.get(name, {}))
        deletes = tables.pop("delete", None)
        tables = {k: prepare_new_rows(spec, k, v) for k, v in tables.items() if k not in spec.skip_tables}
        store.apply_version(name, rank, tables, spec.keys, deletes, spec.helper_columns, cascade=cascade)
        updated = True
    return updated


def landed_families(spark: SparkSession, landing: str, office: str, schema: str = "default") -> dict[str, dict[str, SavedTable]]:
    """version -> {table: where it is} of the versions whose landing is complete."""
    return {v: {t: SavedTable(table_folder(landing, office, v, t, schema), *place) for t, place in tables.items()}
            for v, tables in complete_versions(spark, landing, office, schema).items()}


def read_family(spark: SparkSession, saved: Mapping[str, SavedTable]) -> dict[str, DataFrame]:
    """The landed tables of one version."""
    return {name: place.read(spark) for name, place in sorted(saved.items())}


def apply_in_one_pass(store: SnapshotStore, spec: OfficeSpec, landing: str,
                      versions: Sequence[tuple[str, int]],
                      target_bytes: int = TARGET_FILE_BYTES, cascade: bool = False) -> bool:
    """Single-pass merge of every pending version (equals :func:`apply_in_order`).

    Each table is read once over all pending versions, merged by
    ``bulk_merge`` and written once; the ledger then records every version.
    With ``cascade`` every version reaches every table: for a table a version
    does not carry, the version's keys count as deletes at that version.
    """
    spark = store.spark
    todo = pending_versions(store, versions)
    if not todo:
        return False
    since = store.latest_rank()
    # all ranks are held while they are merged
    with store.claimed(*(r for _, r in todo)) as held:
        landed = landed_families(spark, landing, spec.office, spec.schemas[0])
        families = {r: read_family(spark, landed.get(n, {})) for n, r in todo}
        tables = sorted(({t for fam in families.values() for t in fam if t != "delete"}
                         | (set(store.tables()) if cascade else set())) - set(spec.skip_tables))
        deletes = [fam["delete"].withColumn(VERSION_COL, F.lit(r)) for r, fam in families.items()
                   if "delete" in fam]
        deletes_df = align_union(*deletes) if deletes else None
        written = {}
        last_rank = todo[-1][1]
        for t in tables:
            parts = [prepare_new_rows(spec, t, fam[t]).withColumn(VERSION_COL, F.lit(r))
                     for r, fam in families.items() if t in fam]
            reached = [r for r, fam in families.items() if t in fam or cascade]
            present = spark.createDataFrame([(r,) for r in reached], f"{VERSION_COL} int")
            current = store.current(t)
            if current is not None:
                current = current.drop(*[c for c in spec.helper_columns if c in current.columns])
            if not parts:  # only reached by cascade: no rows of its own
                if current is None:
                    continue
                parts = [current.withColumn(VERSION_COL, F.lit(None).cast("int")).filter(F.lit(False))]
            del_parts = [] if deletes_df is None else [deletes_df.select(*spec.keys, VERSION_COL)]
            if cascade:  # the keys a version carries in other tables reach this one
                del_parts += [fam[o].select(*spec.keys).withColumn(VERSION_COL, F.lit(r))
                              for r, fam in families.items() if t not in fam
                              for o in fam if o != "delete"]
            dels = align_union(*del_parts) if del_parts else None
            merged = bulk_merge(current, align_union(*parts), dels, present, spec.keys).drop(VERSION_COL)
            written[t] = store.write_snapshot(t, last_rank, merged, target_bytes)
        # one commit for every version
        store.commit_many([(n, r, {}) for n, r in todo[:-1]] + [(todo[-1][0], last_rank, written)], held, since)
    return True


def publish_if_updated(store: SnapshotStore, updated: bool, folder: str,
                       target_bytes: int = TARGET_FILE_BYTES) -> Mapping[str, str]:
    """Publish only when something merged.

    Merge-on-read tables are compacted into full snapshots first (a lasting
    gain for later reads); every table is then published from its snapshot
    with ``coalesce(n)``, so publishing never shuffles."""
    if not updated:
        return {}
    spark = store.spark
    if store.mode == "merge_on_read":  # fold pending deltas into full snapshots first
        for t in store.tables():
            store.compact(t, target_bytes)
    # full snapshots on disk: publish them by a shuffle-free coalesce copy
    # side by side: a table below the target is one task
    snapshots = store.committed()
    out = {t: f"{folder}/{t}.parquet" for t in snapshots}
    # set around the threads too, as each of them puts back what it found
    with session_conf(spark, {"spark.sql.parquet.outputTimestampType": "INT96"}), ThreadPoolExecutor(PUBLISHED_AT_ONCE) as pool:
        list(pool.map(lambda t: compact_files(spark, snapshots[t], out[t], target_bytes, int96=True), out))
    return out


def run_office(spark: SparkSession, spec: OfficeSpec, xml_versions: Sequence[tuple[str, int, str]],
               landing: str, store_root: str, publish_folder: str | None = None,
               single_pass: bool = True, schema=None, mode: str = "rewrite",
               compact_every: int = 16, cascade: bool = False) -> Mapping[str, str]:
    """L1 -> L3 (fold or single pass) -> L6 for one office.

    ``xml_versions``: ``[(version, rank, xml_path)]`` in any order; versions
    already landed are not landed again (F8), versions already in the ledger
    are not applied again.
    """
    store = SnapshotStore(spark, store_root, spec.office, spec.schemas[0], mode=mode, keys=spec.keys,
                          compact_every=compact_every)
    landed = landed_families(spark, landing, spec.office, spec.schemas[0])
    for version, _rank, path in xml_versions:
        if version not in landed:
            land_version(spark, spec, path, landing, version, schema)
    order = [(v, r) for v, r, _ in xml_versions]
    apply = apply_in_one_pass if single_pass else apply_in_order
    updated = apply(store, spec, landing, order, cascade=cascade)
    if publish_folder is None:
        return {}
    return publish_if_updated(store, updated or spec.always_publish, publish_folder)
