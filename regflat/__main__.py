"""Command line: ``python -m regflat <command> ...``.

  office        land + apply the versions below a folder, then publish
                (each sub-folder is one version; names sort in version order;
                a folder holding .zip files is expanded, otherwise read as XML)
  applications  unify the published main tables of the offices
  catalog       list published folders, files and columns

The session comes from ``spark-submit`` / the environment; shared storage is
named by ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import argparse
import re
import sys
from dataclasses import replace

from pyspark.sql import SparkSession, functions as F

from regflat.plans.applications import write_applications
from regflat.plans.catalog import catalog_folders
from regflat.plans.offices import CA, GB, US, em_spec
from regflat.plans.snapshot import SnapshotStore
from regflat.plans.updates import (apply_in_one_pass, apply_in_order, land_archives, land_version,
                                   landed_families, publish_if_updated)
from regflat.session import prepare
from regflat.sources.landing import order_versions

SPECS = {"us": US, "ca": CA, "gb": GB, "em": em_spec("TradeMark"), "em-ir": em_spec("InternationalRegistration"),
         "em-applicant": em_spec("Applicant")}
MAIN_TABLES = {"us": "case-file-header", "ca": "Trademark", "em": "TradeMark", "gb": "Application"}


# Feed phases in merge order (other feeds have no phase).
PHASES = {"gb": ("full", "rollup_old", "rollup", "new"), "em": ("Full", "Differential")}


def _versions(spark: SparkSession, root: str, office: str = "gb") -> list[tuple[str, int, str, bool]]:
    """Versions below ``root``: (name, rank, path, zipped), in merge order.

    A version is the folder holding the files; a zip that lies in a phase
    folder is a version of its own.  Where an office has phases the rank
    follows (phase, name): the phase is the first level, or the second below
    ``rollup`` (the feed keeps ``rollup/rollup_old`` and ``rollup/rollup``).
    An unknown phase raises."""
    base = root.rstrip("/")
    phases = next((p for o, p in PHASES.items() if office == o or office.startswith(o + "-")), ())
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
             .load(base).select("path"))
    rel = F.regexp_extract("path", "^(?:file:)?" + re.escape(base.removeprefix("file:")) + r"/(.+)$", 1)
    folder = F.regexp_replace(rel, "/[^/]+$", "")
    zipped = F.endswith(rel, F.lit(".zip"))
    alone = zipped & folder.isin(*phases) if phases else F.lit(False)
    listing = (files.select(F.when(alone, F.regexp_replace(rel, r"\.zip$", "")).otherwise(folder).alias("version"),
                            F.when(alone, rel).otherwise(folder).alias("place"), zipped.alias("zipped"))
               .groupBy("version", "place").agg(F.max("zipped").alias("zipped")))
    if phases:
        first = F.substring_index("version", "/", 1)
        second = F.element_at(F.split(F.concat("version", F.lit("/")), "/"), 2)
        phase = F.when((first == "rollup") & second.isin(*phases), second).otherwise(first)
        rank = F.array_position(F.array(*map(F.lit, phases)), phase)
        rank = F.when(rank > 0, rank).otherwise(F.raise_error(F.concat(F.lit("unknown phase: "), "version")).cast("long"))
        listing = listing.withColumn("phase_rank", rank)
    else:
        listing = listing.withColumn("phase_rank", F.lit(0))
    ranked = order_versions(listing, ["phase_rank", "version"]).collect()  # one row per version
    return [(r["version"].replace("/", "__"), r["rank"], f"{base}/{r['place']}", r["zipped"]) for r in ranked]


def cmd_office(spark: SparkSession, a: argparse.Namespace) -> None:
    spec = SPECS[a.office]
    if a.skip_table:
        spec = replace(spec, skip_tables=tuple(a.skip_table))
    store = SnapshotStore(spark, a.store, spec.office, spec.schemas[0], mode=a.mode, keys=spec.keys)
    landed = landed_families(spark, a.landing, spec.office, spec.schemas[0])
    versions = _versions(spark, a.versions, a.office)
    for name, _rank, path, zipped in versions:
        if name not in landed:
            (land_archives if zipped else land_version)(spark, spec, path, a.landing, name)
    order = [(n, r) for n, r, _, _ in versions]
    apply = apply_in_order if a.ordered or a.mode == "merge_on_read" else apply_in_one_pass
    updated = apply(store, spec, a.landing, order, cascade=a.cascade)
    if a.publish:
        out = publish_if_updated(store, updated or spec.always_publish, a.publish)
        print("\n".join(f"{t}\t{p}" for t, p in sorted(out.items())))
    if a.keep:
        store.expire(a.keep)


def cmd_applications(spark: SparkSession, a: argparse.Namespace) -> None:
    frames = {}
    for item in a.office:
        office, path = item.split("=", 1)
        frames[office] = spark.read.parquet(f"{path.rstrip('/')}/{MAIN_TABLES[office]}.parquet")
    write_applications(frames, a.out)


def cmd_catalog(spark: SparkSession, a: argparse.Namespace) -> None:
    folders = dict(item.split("=", 1) for item in a.folder)
    found = catalog_folders(spark, folders).orderBy("folder", "file", "position")
    if a.out:
        found.write.mode("overwrite").parquet(a.out)
        return
    print("\t".join(found.columns))
    for r in found.toLocalIterator():
        print("\t".join("" if x is None else str(x) for x in r))


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="python -m regflat")
    sub = p.add_subparsers(dest="cmd", required=True)
    o = sub.add_parser("office")
    o.add_argument("--office", required=True, choices=sorted(SPECS))
    o.add_argument("--versions", required=True, help="folder with one sub-folder per version")
    o.add_argument("--landing", required=True)
    o.add_argument("--store", required=True)
    o.add_argument("--publish")
    o.add_argument("--mode", default="rewrite", choices=["rewrite", "merge_on_read"])
    o.add_argument("--ordered", action="store_true", help="one merge and commit per version instead of a single pass")
    o.add_argument("--single-pass", action="store_true", help="the default")
    o.add_argument("--skip-table", action="append", help="land this table but do not merge it")
    o.add_argument("--cascade", action="store_true")
    o.add_argument("--keep", type=int, default=2, help="snapshots to keep per table (0: all)")
    ap = sub.add_parser("applications")
    ap.add_argument("--office", action="append", required=True, help="office=published folder")
    ap.add_argument("--out", required=True)
    c = sub.add_parser("catalog")
    c.add_argument("--folder", action="append", required=True, help="label=published folder")
    c.add_argument("--out", help="write the catalog as Parquet instead of printing it")
    a = p.parse_args(argv)
    spark = SparkSession.builder.appName(f"regflat-{a.cmd}").getOrCreate()
    prepare(spark)
    {"office": cmd_office, "applications": cmd_applications, "catalog": cmd_catalog}[a.cmd](spark, a)


if __name__ == "__main__":
    main(sys.argv[1:])
