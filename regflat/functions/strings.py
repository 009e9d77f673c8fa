"""Small string / date helpers used on listings and version names (K1-K4)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def strip_zip(c: Column) -> Column:
    """K1: drop a trailing ``.zip``."""
    return F.regexp_replace(c, r"\.zip$", "")


def last_chars(c: Column, n: int) -> Column:
    """K1: last ``n`` characters."""
    return F.right(c, F.lit(n))


def base_name(path: Column) -> Column:
    """K3: file or folder name without directory and without .zip/.parquet."""
    return F.regexp_extract(path, r"([^/]+?)(\.zip|\.parquet)?/?$", 1)


def day_names(start: Column, end: Column, fmt: str = "yyMMdd") -> Column:
    """Array of day names in the half-open range [start, end)."""
    last = F.date_sub(end, 1)
    days = F.when(last >= start, F.sequence(start, last, F.expr("INTERVAL 1 DAY")))
    return F.transform(F.coalesce(days, F.array().cast("array<date>")),
                       lambda d: F.date_format(d, fmt))


def padded_numbers(n: Column, width: int = 2) -> Column:
    """Historical series names ``01``..``n``."""
    return F.transform(F.sequence(F.lit(1), n), lambda i: F.lpad(i.cast("string"), width, "0"))
