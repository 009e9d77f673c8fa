"""Session construction and the shared scratch location.

Everything that must outlive a task (snapshots, checkpoints, landed
archives) is written below ``spark.checkpoint.dir``, which a cluster sets
to shared storage.  Only when it is unset (tests, a laptop) do we create a
private directory and register it as the checkpoint dir.
"""

from __future__ import annotations

import os
import tempfile
import threading
import uuid
import zipfile

from pyspark.sql import SparkSession

# Session settings that matter for this workload at any scale.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "regflat", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    prepare(spark)
    return spark


_SHIPPED: set[str] = set()
_SHIP_LOCK = threading.Lock()


def ship_package(spark: SparkSession) -> None:
    """Make ``regflat`` importable in Python workers (as ``--py-files`` would).

    Functions run by ``mapInPandas`` reference module-level helpers, so the
    executors need the package; it is zipped once per application and added
    with ``addPyFile``, which Spark distributes to every executor.
    """
    sc = spark.sparkContext
    app = sc.applicationId
    with _SHIP_LOCK:
        if app in _SHIPPED:
            return
        pkg = os.path.dirname(os.path.abspath(__file__))
        out = os.path.join(tempfile.mkdtemp(prefix="regflat-pyfiles-"), "regflat.zip")
        with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as zf:
            for base, _dirs, files in os.walk(pkg):
                for f in files:
                    if f.endswith(".py"):
                        full = os.path.join(base, f)
                        zf.write(full, os.path.relpath(full, os.path.dirname(pkg)))
        sc.addPyFile(out)
        _SHIPPED.add(app)


def prepare(spark: SparkSession) -> str:
    """Shared scratch folder + package on the executors; returns the scratch root."""
    ship_package(spark)
    return checkpoint_root(spark)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Read from the session.  Where it is unset a local master gets a private
    folder; any other master raises, because executors would not share it.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="regflat-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def work_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh, unique (not yet existing) path under the shared checkpoint root."""
    root = checkpoint_root(spark)
    return f"{root}/regflat-work/{purpose}-{uuid.uuid4().hex[:12]}"
