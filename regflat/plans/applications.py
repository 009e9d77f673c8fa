"""Unified applications table."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from regflat.operators.flatten import q
from regflat.plans.publish import compact_table

UNIFIED = ("ip_office", "application_number", "application_date", "registration_date")

# ---------------------------------------------------------------------------
# Source column per office for each unified column.
OFFICE_COLUMNS = {
    "us": {"application_number": "serial-number", "application_date": "filing-date",
           "registration_date": "registration-date"},
    "ca": {"application_number": "ApplicationNumber", "application_date": "ApplicationDate",
           "registration_date": "RegistrationDate"},
    "em": {"application_number": "ApplicationNumber", "application_date": "ApplicationDate",
           "registration_date": "RegistrationDate"},
    "gb": {"application_number": "ApplicationNumber", "application_date": "ApplicationDateTime",
           "registration_date": "RegistrationDate"},
}
# ---------------------------------------------------------------------------


def office_projection(df: DataFrame, office: str, columns: Mapping[str, str | None]) -> DataFrame:
    """P8 + K10: rename to the unified schema and tag the office.

    A mapped column that is absent (or mapped to None) becomes a typed null.
    GB rows carry ``gb`` (the published code tagged them ``em``).
    """
    def pick(target: str, dtype: str) -> F.Column:
        src = columns.get(target)
        if src is None or src not in df.columns:
            return F.lit(None).cast(dtype).alias(target)
        return q(src).cast(dtype).alias(target)

    return df.select(F.lit(office).alias("ip_office"),
                     pick("application_number", "string"),
                     pick("application_date", "timestamp"),
                     pick("registration_date", "timestamp"))


def applications(frames: Mapping[str, DataFrame],
                 columns: Mapping[str, Mapping[str, str | None]] = OFFICE_COLUMNS) -> DataFrame:
    """Union-all of the office projections (no distinct)."""
    out = None
    for office, df in frames.items():
        p = office_projection(df, office, columns[office])
        out = p if out is None else out.unionByName(p)
    return out


def write_applications(frames: Mapping[str, DataFrame], path: str) -> None:
    """Publish the unified table (INT96 timestamps, sized files),
    partitioned by ``ip_office`` so a filter on offices prunes folders."""
    compact_table(applications(frames), path, int96=True, partition_by=("ip_office",))
