"""Claims on ranks, so that of two writers exactly one commits a version.

A claim is a file created only if absent: ``rank=<r>/<attempt>``.  It is taken before any folder of the rank is written,
and the loser raises.  A writer that fails releases its claim; one that dies leaves it, and after ``lease`` seconds the
next writer takes the rank over under the next attempt, whose folders have names of their own.  The commit itself is one
more file created only if absent, ``rank=<r>/commit``, which lists what is committed; the ledger rows follow from it, so a
writer that was taken over cannot commit any more, and one that dies between the two is completed by the next.

HDFS creates a file only if absent in one step, and so does the local file system here; an object store must be set to
conditional writes.
"""

from __future__ import annotations

import json
import os
import re
import time
import uuid
from typing import NamedTuple

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

from regflat.plans.publish import _file_system

LEASE = 6 * 3600


class Conflict(RuntimeError):
    """Another writer has this rank, or has moved the state on."""


class Claim(NamedTuple):
    folder: str
    attempt: int


def create_if_absent(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file; false where there is one already."""
    local = re.sub(r"^file:/*", "/", path)
    if local.startswith("/"):
        os.makedirs(os.path.dirname(local), exist_ok=True)
        # a name of its own first: the linked file is whole as soon as it can be seen
        own = f"{os.path.dirname(local)}/.{uuid.uuid4().hex}"
        with open(own, "x") as f:
            f.write(text)
        try:
            os.link(own, local)
            return True
        except FileExistsError:
            return False
        finally:
            os.unlink(own)
    fs, target = _file_system(spark, path)
    try:
        out = fs.create(target, False)
    except Py4JJavaError as exc:
        if "AlreadyExists" in str(exc.java_exception):
            return False
        raise
    out.write(bytearray(text.encode()))
    out.close()
    return True


def _listed(spark: SparkSession, folder: str) -> dict[str, float]:
    """Names in a folder with their times in seconds."""
    fs, target = _file_system(spark, folder)
    if not fs.exists(target):
        return {}
    return {s.getPath().getName(): s.getModificationTime() / 1000 for s in fs.listStatus(target)}


def _attempts(names) -> list[int]:
    return sorted(int(n) for n in names if n.isdigit())


def claim(spark: SparkSession, base: str, rank: int, lease: float = LEASE) -> Claim:
    """Take a rank, or raise :class:`Conflict`."""
    folder = f"{base}/rank={rank}"
    names = _listed(spark, folder)
    attempts = _attempts(names)
    attempt = 0
    if attempts:
        last = attempts[-1]
        if f"{last}.released" not in names and time.time() - names[str(last)] < lease:
            raise Conflict(f"rank {rank} is being written by another writer")
        attempt = last + 1
    if not create_if_absent(spark, f"{folder}/{attempt}", f"{os.getpid()} {time.time():.0f}"):
        raise Conflict(f"rank {rank} was taken by another writer")
    return Claim(folder, attempt)


def release(spark: SparkSession, held: Claim) -> None:
    """Give a rank back after a failure."""
    create_if_absent(spark, f"{held.folder}/{held.attempt}.released", "")


def commit(spark: SparkSession, held: Claim, entries: list) -> None:
    """Make the claim's rank committed, once and for all; raises where it was taken over or committed."""
    last = _attempts(_listed(spark, held.folder))[-1]
    if last != held.attempt or not create_if_absent(spark, f"{held.folder}/commit", json.dumps(entries)):
        raise Conflict(f"{held.folder} was taken over by another writer")


def committed(spark: SparkSession, base: str, rank: int) -> list | None:
    """What a rank's commit file lists, if there is one."""
    path = f"{base}/rank={rank}/commit"
    if "commit" not in _listed(spark, path.rsplit("/", 1)[0]):
        return None
    text = "\n".join(r.value for r in spark.read.text(path).collect())
    return json.loads(text) if text else None
