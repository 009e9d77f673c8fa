"""regflat: a Spark-native pipeline for bulk nested register records.

Records (nested XML published as a historical series plus deltas) are
scanned with Spark, split into a family of keyed flat tables by a
schema-driven flatten, cleaned by declarative per-office name and type
rules, merged by key (delete, replace, append) either version by version
or in one pass, committed as ledger-tracked snapshots and published.
"""

from regflat.session import build_session, work_dir

__all__ = ["build_session", "work_dir"]
