"""Versioned snapshots committed through the ledger.

Each written table goes to a *new* folder; only then is the version appended
to the ledger.  Readers resolve a table through the ledger, so they see the
old state until the ledger append, and a failure before it leaves nothing to
roll back.  No folder is ever overwritten while it is read.

Two modes:

* ``rewrite`` (the published behaviour): every version merges into a full
  new snapshot ``<table>/v=<rank>``.
* ``merge_on_read``: a version writes only its own rows (``<table>/d=<rank>``)
  and its delete keys; a reader resolves the table as the single-pass merge of
  the newest full snapshot and the deltas after it (equal to the ordered fold,
  see ``bulk_merge``).  Every ``compact_every`` deltas a table is compacted
  into a new full snapshot.  At 100 TB this turns "rewrite every table for
  every daily version" into "write the day's rows; rewrite once per k days".

Two writers: a rank is claimed before any of its folders is written (see
``claims``) and committed by one file created only if absent; the loser
raises.  A rewriting version also raises if the state that it merged into has
moved on meanwhile.  Folders of a repeated attempt have names of their own
(``v=<rank>.<attempt>``), so a committed folder is never written again.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F

from regflat.operators.key_screen import remove_keys_screened
from regflat.operators.merge import (VERSION_COL, align_union, bulk_merge, key_set, remove_keys,
                                     update_table)
from regflat.plans import claims
from regflat.plans.ledger import append_ledger, read_ledger
from regflat.plans.publish import TARGET_FILE_BYTES, remove_folder, save_table, session_conf

# Runtime (AQE) broadcast limit for merge writes: about half a million keys.
# A broadcast is gathered, hashed and cut up on the driver, where it takes
# several times its size, so it must not grow with the table.
MERGE_BROADCAST_BYTES = 32 * 1024 * 1024


class SnapshotStore:
    def __init__(self, spark: SparkSession, root: str, office: str, schema: str = "default",
                 mode: str = "rewrite", keys: Sequence[str] = (), compact_every: int = 16,
                 lease: float = claims.LEASE, screen: bool = False):
        if mode not in ("rewrite", "merge_on_read"):
            raise ValueError(f"unknown mode {mode!r}")
        if mode == "merge_on_read" and not keys:
            raise ValueError("merge_on_read needs the merge keys")
        self.spark = spark
        self.root = root.rstrip("/")
        self.office = office
        self.schema = schema
        self.mode = mode
        self.keys = tuple(keys)
        self.compact_every = compact_every
        self.lease = lease
        # rewrite mode: rows without a key of the version stay out of the anti-join's exchange
        self._remove = remove_keys_screened if screen else remove_keys
        self._attempt: dict[int, int] = {}  # of the ranks that this store has claimed

    @property
    def ledger_path(self) -> str:
        return f"{self.root}/_ledger"

    def ledger(self) -> DataFrame:
        return read_ledger(self.spark, self.ledger_path).filter(
            (F.col("office") == self.office) & (F.col("schema") == self.schema))

    def _entries(self) -> list:
        """Committed ledger rows of this office/schema (metadata: one row per
        version and table)."""
        return [r for r in self.ledger().filter(F.col("table").isNotNull())
                .select("rank", "table", "snapshot", "kind").collect()]

    def committed(self) -> dict[str, str]:
        """table -> path of its newest committed full snapshot."""
        best: dict[str, tuple[int, str]] = {}
        for r in self._entries():
            if (r["kind"] or "snapshot") == "snapshot" and (r["table"] not in best or r["rank"] >= best[r["table"]][0]):
                best[r["table"]] = (r["rank"], r["snapshot"])
        return {t: p for t, (_, p) in best.items()}

    def tables(self) -> list[str]:
        return sorted({r["table"] for r in self._entries() if (r["kind"] or "snapshot") != "deletes"})

    def latest_rank(self) -> int | None:
        r = self.ledger().agg(F.max("rank").alias("m")).collect()[0]["m"]
        return None if r is None else int(r)

    def committed_versions(self) -> dict[str, int]:
        """Committed version names and their ranks (metadata: one row per version)."""
        return {r["version"]: int(r["rank"]) for r in self.ledger().select("version", "rank").distinct().collect()}

    def _layers(self, table: str):
        """Newest full snapshot of ``table`` and the layers committed after it:
        its deltas, the version-wide deletes, and cascade keys reaching it."""
        entries = self._entries()
        base_rank, base = -1, None
        for r in entries:
            if r["table"] == table and (r["kind"] or "snapshot") == "snapshot" and r["rank"] >= base_rank:
                base_rank, base = r["rank"], r["snapshot"]

        def after(kind, of_table=True):
            # a set: a retried ledger append may repeat rows; a layer is read once
            return sorted({(r["rank"], r["snapshot"]) for r in entries
                           if r["kind"] == kind and r["rank"] > base_rank and (not of_table or r["table"] == table)})
        return base, after("delta"), after("deletes", of_table=False), after("cascade")

    def current(self, table: str) -> DataFrame | None:
        """The table as of the ledger's latest commit."""
        base, deltas, dels, cascades = self._layers(table)
        base_df = None if base is None else self.spark.read.parquet(base)
        if not deltas and not cascades:
            return base_df
        if base_df is None and not deltas:
            return None
        reached = {r for r, _ in deltas} | {r for r, _ in cascades}
        # one read over all delta folders: the ``d=<rank>`` folder is the version
        rows = (self._read_layers([p for _, p in deltas]) if deltas
                else base_df.withColumn(VERSION_COL, F.lit(None).cast("int")).filter(F.lit(False)))
        parts = []
        live = [p for r, p in dels if r in reached]
        if live:
            parts.append(self._read_layers(live).select(*self.keys, VERSION_COL))
        if cascades:
            parts.append(self._read_layers([p for _, p in cascades], "x").select(*self.keys, VERSION_COL))
        deletes = align_union(*parts) if parts else None
        present = self.spark.createDataFrame([(r,) for r in sorted(reached)], f"{VERSION_COL} int")
        return bulk_merge(base_df, rows, deletes, present, self.keys).drop(VERSION_COL)

    def _read_layers(self, paths: list[str], column: str = "d") -> DataFrame:
        base = paths[0].rsplit("/", 1)[0]
        df = (self.spark.read.option("basePath", base).option("mergeSchema", "true").parquet(*paths))
        return df.withColumn(VERSION_COL, F.col(column).cast("int")).drop(column)

    @property
    def _claims(self) -> str:
        return f"{self.root}/_claims/{self.office}/{self.schema}"

    def _name(self, rank: int) -> str:
        """Folder name of a rank; a repeated attempt has one of its own (still read as the rank)."""
        attempt = self._attempt.get(rank, 0)
        return f"{rank}.{attempt}" if attempt else str(rank)

    @contextmanager
    def claimed(self, *ranks: int):
        """Hold ranks while they are written; given back on a failure.  What a dead writer committed without its ledger
        rows is completed, and the rank refused."""
        held = []
        try:
            for rank in ranks:
                entries = claims.committed(self.spark, self._claims, rank)
                if entries is not None:
                    if rank not in self.committed_versions().values():
                        self._append(entries)
                    raise ValueError(f"rank {rank} is already committed")
                held.append(claims.claim(self.spark, self._claims, rank, self.lease))
                self._attempt[rank] = held[-1].attempt
            yield held
        except BaseException:
            for h in held:
                claims.release(self.spark, h)
            raise

    def compact(self, table: str, target_bytes: int = TARGET_FILE_BYTES) -> str | None:
        """Fold the deltas of ``table`` into a new full snapshot (merge-on-read)."""
        base, deltas, _, cascades = self._layers(table)
        if not deltas and not cascades:
            return base
        rank = max(r for r, _ in deltas + cascades)
        version = self.ledger().filter(F.col("rank") == rank).select("version").first()["version"]
        # a claim of its own: the rank itself is committed, its snapshot is what is new
        held = claims.claim(self.spark, f"{self._claims}/compact/{table}", rank, self.lease)
        before, self._attempt[rank] = self._attempt.get(rank, 0), held.attempt
        try:
            path = self.write_snapshot(table, rank, self.current(table), target_bytes)
            entries = [(version, rank, {table: ("snapshot", path)})]
            claims.commit(self.spark, held, entries)
        except BaseException:
            claims.release(self.spark, held)
            raise
        finally:
            self._attempt[rank] = before
        self._append(entries)
        return path

    def snapshot_path(self, table: str, rank: int) -> str:
        return f"{self.root}/{self.office}/{self.schema}/{table}/v={self._name(rank)}"

    def write_snapshot(self, table: str, rank: int, df: DataFrame,
                       target_bytes: int = TARGET_FILE_BYTES) -> str:
        """Write a merged table.  During the write, AQE may broadcast a
        join side whose *measured* size is under ``MERGE_BROADCAST_BYTES``
        (the distinct delta keys of a daily version), so the large current
        table is anti-joined map-side instead of shuffled; above it the
        sort-merge join with skew splitting stays."""
        path = self.snapshot_path(table, rank)
        with session_conf(self.spark, {"spark.sql.adaptive.autoBroadcastJoinThreshold":
                                       str(MERGE_BROADCAST_BYTES)}):
            # files as the tasks come: ``coalesce`` here would run the partitions of the join one after another in a
            # few tasks.  Small files do not add up, as a scan packs them into splits; publishing sizes them
            save_table(df, path, target_bytes, mode="overwrite", rebalance=False)
        return path

    def expire(self, keep: int = 2) -> list[str]:
        """Delete the folders that no reader resolves any more: per table all but the newest ``keep``
        snapshots, and the layers that the oldest of those already holds.  Returns the deleted folders."""
        entries = self._entries()
        gone, floors = [], []
        for table in self.tables():
            full = sorted({(r["rank"], r["snapshot"]) for r in entries
                           if r["table"] == table and (r["kind"] or "snapshot") == "snapshot"})
            kept = full[-max(1, keep):]
            floor = kept[0][0] if kept else -1
            floors.append(floor)
            live = {p for _, p in kept}
            gone += [p for _, p in full if p not in live]
            gone += [r["snapshot"] for r in entries
                     if r["table"] == table and r["kind"] in ("delta", "cascade") and r["rank"] <= floor]
        # delete keys reach every table: they go once all tables have passed them
        gone += [r["snapshot"] for r in entries if r["kind"] == "deletes" and floors and r["rank"] <= min(floors)]
        gone = sorted(set(gone))
        for path in gone:
            remove_folder(self.spark, path)
        return gone

    def commit_many(self, entries, held: Sequence[claims.Claim] = (), since: int | None = None) -> None:
        """Commit versions; with claims, the file of the last one is what counts, and ``since`` is the rank that the
        state merged into had (None: no version)."""
        if held:
            if self.mode == "rewrite" and self.latest_rank() != since:
                raise claims.Conflict(f"rank {self.latest_rank()} was committed meanwhile")
            claims.commit(self.spark, held[-1], list(entries))
        self._append(entries)

    def _append(self, entries) -> None:
        append_ledger(self.spark, self.ledger_path, self.office, self.schema,
                      [(v, r, {t: tuple(x) if isinstance(x, list) else x for t, x in w.items()}) for v, r, w in entries])

    def apply_version(self, version: str, rank: int, tables: Mapping[str, DataFrame],
                      keys: Sequence[str], deletes: DataFrame | None = None,
                      helper_columns: Sequence[str] = (), fail_before_commit: bool = False,
                      cascade: bool = False) -> dict[str, str]:
        """Merge one version's tables, write snapshots, then commit.

        By default only tables present in the version are touched (their
        deletes too), as published (R6).  With ``cascade`` the version's keys
        (of any of its tables) and its deletes also remove the rows of tables
        the version does not carry.  ``fail_before_commit`` simulates a crash
        between the table writes and the ledger append (recovery tests).
        A version or rank that the ledger already has is refused, so a
        committed folder is never written again.
        """
        done = self.committed_versions()
        if version in done or rank in done.values():
            raise ValueError(f"version {version!r} or rank {rank} is already committed")
        since = max(done.values(), default=None)
        with self.claimed(rank) as held:
            if self.mode == "merge_on_read":
                written = self._append_version(rank, tables, deletes, helper_columns, cascade)
            else:
                written = self._rewrite_version(rank, tables, keys, deletes, helper_columns, cascade)
            if fail_before_commit:
                raise RuntimeError(f"simulated failure before committing version {version}")
            self.commit_many([(version, rank, written)], held, since)
        for name in [n for n, x in written.items() if x[0] in ("delta", "cascade")]:
            layers = self._layers(name)
            if len(layers[1]) + len(layers[3]) >= self.compact_every:
                self.compact(name)
        return {k: x[1] if isinstance(x, tuple) else x for k, x in written.items()}

    def _rewrite_version(self, rank, tables, keys, deletes, helper_columns, cascade) -> dict:
        written = {}
        for name, new in tables.items():
            merged = update_table(self.current(name), new, keys, deletes, helper_columns, self._remove)
            written[name] = self.write_snapshot(name, rank, merged)
        if cascade:
            reach = key_set(*tables.values(), deletes, keys=keys)
            for name in self.tables():
                if name not in tables and reach is not None:
                    kept = self._remove(self.current(name), reach, keys)
                    written[name] = self.write_snapshot(name, rank, kept)
        return written

    def _append_version(self, rank, tables, deletes, helper_columns, cascade=False) -> dict:
        """merge_on_read: write the version's rows and delete keys only; with
        ``cascade`` also the keys reaching each table the version lacks."""
        base = f"{self.root}/{self.office}/{self.schema}"
        written: dict[str, tuple[str, str]] = {}
        for name, new in tables.items():
            new = new.drop(*[c for c in helper_columns if c in new.columns])
            path = f"{base}/{name}/d={self._name(rank)}"
            save_table(new, path, mode="overwrite")
            written[name] = ("delta", path)
        if deletes is not None and (tables or cascade):
            path = f"{base}/_deletes/d={self._name(rank)}"
            save_table(deletes.select(*self.keys), path, mode="overwrite")
            written["delete"] = ("deletes", path)
        if cascade:
            reach = key_set(*tables.values(), deletes, keys=self.keys)
            for name in self.tables():
                if name not in tables and reach is not None:
                    path = f"{base}/{name}/x={self._name(rank)}"
                    save_table(reach, path, mode="overwrite")
                    written[name] = ("cascade", path)
        return written
