"""Column-name rules.

These run at plan time on the list of column names: the result is a
single ``toDF``/``select`` with aliases, so no data moves.  Flattened
names join parent and child with a pipe, e.g. ``case-file|serial-number``.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

SEP = "|"

# ---------------------------------------------------------------------------
# Fixed values that must equal the published behaviour (do not edit).
# Namespace / marker tokens removed from every name, in this order.
CA_STRIP_TOKENS = ("cacom:", "@com:", "com:", "catmk:", "tmk:", "@xsi:", "#")
EM_STRIP_TOKENS = ("@", "#", "ClassDescriptionDetails|ClassDescription|", "BasicRecord|")
GB_STRIP_TOKENS = ("MarkLicenceeExportList|", "@", "#")
# Long CA prefixes shortened; first matching prefix wins (P5).
CA_PREFIX_RENAMES = (
    ("MarkDescriptionBag|", ""),
    ("MarkReproduction|MarkImageBag|MarkImage|MarkImageClassification|"
     "FigurativeElementClassificationBag|ViennaClassificationBag|ViennaClassification|"
     "ViennaDescriptionBag|", ""),
    ("MarkReproduction|MarkImageBag|MarkImage|MarkImageClassification|"
     "FigurativeElementClassificationBag|ViennaClassificationBag|", ""),
    ("MarkReproduction|MarkImageBag|", ""),
    ("MarkReproduction|MarkSoundBag|", ""),
    ("MarkReproduction|WordMarkSpecification|", "WordMarkSpecification|"),
)
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class NameRules:
    """How one office cleans flattened names.

    strip_tokens: substrings removed everywhere, in order.
    container_suffix: for a table named ``<X><suffix>`` the first
        ``<X>|`` is also removed (``Bag`` for CA, ``Details`` for EM).
    prefix_renames: ordered (prefix, replacement); first match wins.
    """

    strip_tokens: tuple[str, ...] = ()
    container_suffix: str | None = None
    prefix_renames: tuple[tuple[str, str], ...] = field(default_factory=tuple)

    def clean(self, name: str, table: str | None = None) -> str:
        new = name
        for token in self.strip_tokens:
            new = new.replace(token, "")
        if table:
            new = new.replace(table + SEP, "", 1)
            if self.container_suffix and table.endswith(self.container_suffix):
                new = new.replace(table.replace(self.container_suffix, SEP), "", 1)
        if new.endswith(SEP):
            new = new[:-1]
        return new

    def rename(self, name: str) -> str:
        for prefix, repl in self.prefix_renames:
            if name.startswith(prefix):
                return name.replace(prefix, repl, 1)
        return name


CA_NAMES = NameRules(CA_STRIP_TOKENS, "Bag", CA_PREFIX_RENAMES)
EM_NAMES = NameRules(EM_STRIP_TOKENS, "Details")
GB_NAMES = NameRules(GB_STRIP_TOKENS)
US_NAMES = NameRules()


class NameCollision(ValueError):
    """Two source columns would end up with one name (Spark refuses such a write)."""


def rename_columns(df: DataFrame, fn: Callable[[str], str]) -> DataFrame:
    """Apply a name function to every column; fail at plan time on collisions.

    Collisions are checked case-insensitively, the way Parquet writers and
    Spark's default resolver see them.
    """
    olds = df.columns
    news = [fn(c) for c in olds]
    seen: dict[str, str] = {}
    for old, new in zip(olds, news):
        key = new.lower()
        if key in seen:
            raise NameCollision(f"columns {seen[key]!r} and {old!r} both clean to {new!r}")
        seen[key] = old
    if news == olds:
        return df
    return df.toDF(*news)


def clean_names(df: DataFrame, rules: NameRules, table: str | None = None) -> DataFrame:
    """Strip tokens / table prefix / trailing pipe."""
    return rename_columns(df, lambda c: rules.clean(c, table))


def shorten_prefixes(df: DataFrame, rules: NameRules = CA_NAMES) -> DataFrame:
    """P5: shorten known long prefixes."""
    return rename_columns(df, rules.rename)


def rename_one(df: DataFrame, old: str, new: str) -> DataFrame:
    """Rename a single column (no-op when absent)."""
    return df.withColumnRenamed(old, new) if old in df.columns else df


def strip_prefix(names: Sequence[str], prefix: str) -> list[str]:
    return [n[len(prefix):] if n.startswith(prefix) else n for n in names]
