"""Feed manifest scan (S3): HTML listing pages -> ``(file_name, volume)``.

The files are the rows of two HTML tables (``file_list``): weekly files with
their volume, and historical files whose name ends in it.  Listings of anchors
are read by ``anchors`` and ``manifest_rows``.  Rows come from
``regexp_extract_all`` over the page text and ``explode``,
all JVM-side; each page is one row, so pages parse in parallel.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from regflat.functions.strings import last_chars, strip_zip

# An anchor inside a list item: group 1 is the target, group 2 the text.
ANCHOR = r'<li><a href="([^"]*)">([^<]*)</a></li>'


def anchors(pages: DataFrame, html_col: str = "html", keep: tuple[str, ...] = ()) -> DataFrame:
    """Explode every ``<li><a href=..>text</a></li>`` into ``(href, text)`` rows."""
    hrefs = F.regexp_extract_all(F.col(html_col), F.lit(ANCHOR), 1)
    texts = F.regexp_extract_all(F.col(html_col), F.lit(ANCHOR), 2)
    return (pages.select(*keep, F.arrays_zip(hrefs.alias("href"), texts.alias("text")).alias("_a"))
            .select(*keep, F.explode("_a").alias("_a"))
            .select(*keep, "_a.href", "_a.text"))


def table_rows(pages: DataFrame, html_col: str = "html", keep: tuple[str, ...] = ()) -> DataFrame:
    """Explode the HTML tables of listing pages into ``(table_no, row_no, cells)``: data rows only, cells as plain text."""
    def parts(text: Column, pattern: str) -> Column:
        return F.regexp_extract_all(text, F.lit(pattern), 1)

    def plain(cell: Column) -> Column:
        text = F.regexp_replace(cell, r"(?s)<[^>]*>", " ")
        for entity, char in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
            text = F.replace(text, F.lit(entity), F.lit(char))
        return F.trim(F.regexp_replace(text, r"\s+", " "))

    tables = pages.select(*keep, F.posexplode(parts(F.col(html_col), r"(?is)<table\b[^>]*>(.*?)</table>")).alias("table_no", "_t"))
    rows = tables.select(*keep, "table_no", F.posexplode(parts(F.col("_t"), r"(?is)<tr\b[^>]*>(.*?)</tr>")).alias("row_no", "_r"))
    cells = F.transform(parts(F.col("_r"), r"(?is)<td\b[^>]*>(.*?)</td>"), plain)
    return rows.select(*keep, "table_no", "row_no", cells.alias("cells")).where(F.size("cells") > 0)


def weekly_files(rows: DataFrame, corrections: Mapping[str, str] | None = None) -> DataFrame:
    """P9/P10 for the first table of a listing: file name and volume are its first two columns."""
    df = rows.where("table_no = 0").select(
        *[c for c in rows.columns if c not in ("table_no", "row_no", "cells")],
        F.get("cells", F.lit(1)).alias("volume"), F.get("cells", F.lit(0)).alias("file_name"))
    return df.replace(dict(corrections), subset=["file_name"]) if corrections else df


def historical_files(rows: DataFrame, excluded_substrings: tuple[str, ...] = ("index", "Schema")) -> DataFrame:
    """K1/K2/F4 for the second table: the volume is the end of the file name; index and schema files are left out."""
    name = F.get("cells", F.lit(0))
    df = rows.where("table_no = 1").select(
        *[c for c in rows.columns if c not in ("table_no", "row_no", "cells")],
        last_chars(strip_zip(name), 3).alias("volume"), name.alias("file_name"))
    for part in excluded_substrings:
        df = df.where(~F.col("file_name").contains(part))
    return df


def file_list(pages: DataFrame, html_col: str = "html", keep: tuple[str, ...] = (),
              corrections: Mapping[str, str] | None = None) -> DataFrame:
    """The historical files, then the weekly ones (``part_rank``), of listing pages with both tables."""
    rows = table_rows(pages, html_col, keep)
    return concat_parts(historical_files(rows), weekly_files(rows, corrections))


def manifest_rows(links: DataFrame, name_col: str, target_col: str,
                  corrections: Mapping[str, str] | None = None,
                  excluded_substrings: tuple[str, ...] = ("index", "Schema")) -> DataFrame:
    """Positional pick, corrections, volume, exclusions."""
    df = links.select(*links.columns[:2]).toDF(name_col, target_col) \
        if links.columns[:2] != [name_col, target_col] else links
    if corrections:
        df = df.replace(dict(corrections), subset=[name_col])
    keep: Column = F.lit(True)
    for s in excluded_substrings:
        keep = keep & ~F.col(name_col).contains(s)
    return (df.filter(keep)
            .withColumn("volume", last_chars(strip_zip(F.col(target_col)), 3)))


def concat_parts(*parts: DataFrame) -> DataFrame:
    """Concatenate manifest parts keeping their order in ``part_rank``."""
    out = None
    for i, p in enumerate(parts):
        p = p.withColumn("part_rank", F.lit(i))
        out = p if out is None else out.unionByName(p)
    return out


def sort_manifest(df: DataFrame) -> DataFrame:
    """O1: order by part, then volume."""
    return df.orderBy("part_rank", "volume")
