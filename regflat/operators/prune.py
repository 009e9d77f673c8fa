"""Column pruning by name rules.

Rules are evaluated on names at plan time; the result is one projection,
so Catalyst prunes the dropped leaves all the way down to the scan.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from regflat.operators.flatten import q


@dataclass(frozen=True)
class DropRules:
    """A column is dropped when any rule matches its name."""

    suffixes: tuple[str, ...] = ()
    contains: tuple[str, ...] = ()
    equals: tuple[str, ...] = ()
    # (prefix, keep_if_contains): drop names starting with prefix unless
    # they contain keep_if_contains (None: always drop).
    prefixes: tuple[tuple[str, str | None], ...] = field(default_factory=tuple)

    def drops(self, name: str) -> bool:
        if name in self.equals:
            return True
        if any(name.endswith(s) for s in self.suffixes):
            return True
        if any(s in name for s in self.contains):
            return True
        for prefix, keep in self.prefixes:
            if name.startswith(prefix) and (keep is None or keep not in name):
                return True
        return False


# ---------------------------------------------------------------------------
# Fixed values that must equal the published behaviour (do not edit).
CA_DROP = DropRules(  # P2
    suffixes=("ClassificationKindCode", "CommentText", "|type"),
    contains=("Format", "FileName"),
    equals=("type", "NationalMarkEvent|type", "NationalMarkEvent|MarkEventAdditionalText",
            "NationalOppositionCaseType"),
)
GB_DROP = DropRules(  # P6
    prefixes=(("MarkSeriesDetails|MarkSeriesItem|Mark3DModel", None),
              ("MarkSeriesDetails|MarkSeriesItem|MarkImage", "Text")),
)
US_UNNECESSARY = ("action-key", "classification|international-code-total-no",
                  "classification|us-code-total-no", "classification|us-code")  # P3
# ---------------------------------------------------------------------------


def drop_by_rules(df: DataFrame, rules: DropRules) -> DataFrame:
    """Drop every column whose name matches a rule."""
    doomed = [c for c in df.columns if rules.drops(c)]
    return df.drop(*doomed) if doomed else df


def drop_present(df: DataFrame, columns: Iterable[str], distinct: bool = False) -> DataFrame:
    """Drop the named columns that exist; optionally distinct rows."""
    doomed = [c for c in columns if c in df.columns]
    out = df.drop(*doomed) if doomed else df
    return out.dropDuplicates() if distinct else out


def select_present(df: DataFrame, keys: Sequence[str], optional: Sequence[str] = ()) -> DataFrame:
    """Keys plus the optional columns that are present, in order."""
    cols = list(keys) + [c for c in optional if c in df.columns]
    return df.select(*[q(c) for c in cols])
