"""Office specifications and record normalisation (N7-US/CA/EM/GB).

One declarative ``OfficeSpec`` per office holds everything that differs:
row tag, keys, change flag and its delete literal, cleaning rules and how a
record splits into tables.  ``normalise`` turns one version's nested rows
into ``{table: DataFrame}``, all lazy projections of the same parent.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, functions as F

from regflat.functions.names import (CA_NAMES, EM_NAMES, GB_NAMES, US_NAMES, clean_names, rename_one,
                                     shorten_prefixes)
from regflat.functions.types import GB_TYPE_RULES, ISO_TYPE_RULES, US_TYPE_RULES
from regflat.operators.flatten import flatten_fully, flatten_once, normalise_struct, q
from regflat.operators.prune import CA_DROP, GB_DROP, US_UNNECESSARY, drop_by_rules, drop_present, select_present
from regflat.operators.rows import filter_equals, live_rows, split_deletes
from regflat.operators.separate import (Cleaning, SuffixSeparation, extract_partial,
                                        extract_subtree, finish_partial, is_container, separate_auto,
                                        separate_by_suffix)


@dataclass(frozen=True)
class OfficeSpec:
    office: str
    row_tag: str
    keys: tuple[str, ...]
    separate: Callable[[DataFrame], dict[str, DataFrame]]
    flag: str | None = None
    delete_literal: str | None = None
    # D1 at merge time, after helper columns are dropped: True = every
    # table, or a tuple of table names.
    dedupe_at_merge: bool | tuple[str, ...] = False
    helper_columns: tuple[str, ...] = ()
    skip_tables: tuple[str, ...] = ()   # landed but not merged; a caller's choice (``dataclasses.replace``), none by default
    publish_folder: str = "open"
    always_publish: bool = False   # L6: GB publishes on every run, the others after a merge
    type_rules: tuple = ()         # K5-K9 rules, for the landing quality table
    schemas: tuple[str, ...] = ("default",)
    extra: dict = field(default_factory=dict)


# ------------------------------------------------------------------ US -----
US_CLEAN = Cleaning(US_NAMES, None, tuple(US_TYPE_RULES), distinct=False)
US_KEYS = ("serial-number",)


def separate_us(df: DataFrame) -> dict[str, DataFrame]:
    """Every container under ``case-file`` is a table keyed by serial number."""
    return separate_auto(df, US_KEYS, US_CLEAN, main_table="case-file")


US = OfficeSpec(
    office="us", row_tag="case-file", keys=US_KEYS, separate=separate_us, type_rules=tuple(US_TYPE_RULES),
    helper_columns=US_UNNECESSARY, dedupe_at_merge=("classifications",),
)

# ------------------------------------------------------------------ CA -----
CA_CLEAN = Cleaning(CA_NAMES, CA_DROP, tuple(ISO_TYPE_RULES), rename_prefixes=True)
CA_KEYS = ("operationCategory", "ApplicationNumber")



@dataclass(frozen=True)
class Container:
    """How one record container becomes tables (declarative CA spec).

    column: the container (after record-level name cleaning).
    table: output table name; default the column without ``Bag``.
    steps: partial flatten steps before sub-trees are split off; 0 means the
        whole container is one fully flattened table.
    subtrees: sub-containers split into ``<table>.<sub without Bag>``.
    extra_key: a key of the container carried into its sub-tree tables.
    drop: containers dropped (with everything below them) before the
        remainder is finished.
    children: containers nested in this one, handled the same way.
    emit: whether the remainder becomes a table itself.
    name_table: the table name the name rule strips when finishing.
    """

    column: str
    table: str | None = None
    steps: int = 0
    subtrees: tuple[str, ...] = ()
    extra_key: str | None = None
    drop: tuple[str, ...] = ()
    children: tuple["Container", ...] = ()
    emit: bool = True
    name_table: str | None = None


# ---------------------------------------------------------------------------
# CA containers and how each becomes tables, in order.
_PROCEEDING_PARTS = ("ProceedingStageBag", "DefendantBag", "PlaintiffBag")
CA_CONTAINERS = (
    Container("GoodsServicesBag", "GoodsServices", steps=2,
              subtrees=("ClassDescriptionBag", "GoodsServicesClassificationBag")),
    Container("LegalProceedingsBag", steps=3, emit=False, children=(
        Container("OppositionProceedingBag", "OppositionProceedings", steps=1, subtrees=_PROCEEDING_PARTS,
                  extra_key="OppositionIdentifier", name_table="OppositionProceedings"),
        Container("CancellationProceedings", "CancellationProceedings", steps=1, subtrees=_PROCEEDING_PARTS,
                  extra_key="LegalProceedingIdentifier", name_table="CancellationProceedings"))),
    Container("MarkEventBag", "MarkEvent", steps=4,
              drop=("NationalMarkEvent|MarkEventOtherLanguageDescriptionTextBag",)),
    Container("ApplicantBag"), Container("PriorityBag"), Container("PublicationBag"),
    Container("AssociatedMarkBag"), Container("DivisionalApplicationBag"), Container("MarkDisclaimerBag"),
    Container("InternationalMarkIdentifierBag"), Container("MarkRepresentation"),
    Container("CorrespondenceAddress"), Container("NationalRepresentative"),
    Container("NationalCorrespondent"), Container("Authorization"), Container("UseRight"),
    Container("UseLimitationText"),
    Container("NationalTrademarkInformation", "NationalTrademark", steps=1, subtrees=(
        "CategorizedTextBag", "ClaimBag", "DoubtfulCaseBag", "FootnoteBag", "IndexHeadingBag",
        "InterestedPartyBag", "TrademarkClass", "Legislation", "Section9", "GeographicalIndication")),
)
# ---------------------------------------------------------------------------


def split_container(df: DataFrame, c: Container, keys: tuple[str, ...], how: Cleaning,
                    out: dict[str, DataFrame]) -> None:
    """Interpret one :class:`Container` over ``df`` (keys + containers)."""
    table = c.table or c.column.replace("Bag", "")
    if not c.steps:
        out[table] = extract_subtree(df, c.column, keys, how)
        return
    stop = c.subtrees + tuple(ch.column for ch in c.children)
    part = extract_partial(df, c.column, keys, c.steps, how, stop_at=stop)
    for ch in c.children:
        if ch.column in part.columns:
            split_container(part, ch, keys, how, out)
    # a dropped container goes with everything flattened out of it
    gone = c.drop + tuple(ch.column for ch in c.children)
    part = drop_present(part, [col for col in part.columns
                               if any(col == g or col.startswith(g + "|") for g in gone)])
    sub_keys = keys + ((c.extra_key,) if c.extra_key and c.extra_key in part.columns else ())
    for sub in c.subtrees:
        if sub in part.columns:
            # the extra key counts as data in the all-null test
            out[f"{table}.{sub.replace('Bag', '')}"] = extract_subtree(part, sub, sub_keys, how, null_except=keys)
            part = part.drop(sub)
    if c.emit:
        out[table] = finish_partial(part, c.name_table or c.column, keys, how)


def normalise_ca_record(df: DataFrame) -> DataFrame:
    """Names on the record, then N3 + P11 on the application number."""
    raw_key = next((c for c in df.columns if CA_NAMES.clean(c) == "ApplicationNumber"), None)
    if raw_key is not None:
        df = normalise_struct(df, raw_key)
    df = clean_names(df, CA_NAMES)
    df = shorten_prefixes(drop_by_rules(df, CA_DROP), CA_NAMES)
    return rename_one(df, "ApplicationNumber|ST13ApplicationNumber", "ApplicationNumber")


def separate_ca(df: DataFrame) -> dict[str, DataFrame]:
    """N7-CA: deletes, one pass of the container spec, leftovers -> Trademark."""
    out: dict[str, DataFrame] = {}
    if "operationCategory" in df.columns:
        out["delete"] = split_deletes(df, "operationCategory", "delete", CA_KEYS)
        df = live_rows(df, "operationCategory", "delete")
    for c in CA_CONTAINERS:
        if c.column in df.columns:  # a missing container yields no table
            split_container(df, c, CA_KEYS, CA_CLEAN, out)
            df = df.drop(c.column)
    out["Trademark"] = finish_partial(df, "TrademarkBag", CA_KEYS, CA_CLEAN)
    return out


CA = OfficeSpec(
    # tables carry CA_KEYS; the merge matches on the application number only
    office="ca", row_tag="tmk:Trademark", keys=("ApplicationNumber",),
    separate=lambda df: separate_ca(normalise_ca_record(df)),
    flag="operationCategory", delete_literal="delete", dedupe_at_merge=True,
    helper_columns=("operationCategory",), type_rules=tuple(ISO_TYPE_RULES),
)

# ------------------------------------------------------------------ EM -----
EM_CLEAN = Cleaning(EM_NAMES, None, tuple(ISO_TYPE_RULES))


def _em_goods(main: str):
    def handler(df: DataFrame, col: str, spec: SuffixSeparation) -> dict[str, DataFrame]:
        flat = clean_names(flatten_fully(df.select(*[q(k) for k in spec.keys], q(col))), EM_NAMES, col)
        keys = [q(k) for k in spec.keys]

        def empty(*cols: str) -> DataFrame:  # R9: a missing column gives an empty table
            return flat.select(*keys, *[F.lit(None).cast("string").alias(c) for c in cols]).filter(F.lit(False))

        out = {}
        if "ClassNumber" in flat.columns:
            out[f"{main}.GoodsServices"] = select_present(
                flat, spec.keys, ("ClassNumber", "ClassificationVersion")).dropDuplicates()
        else:
            out[f"{main}.GoodsServices"] = empty("ClassNumber")
        text, lang = "GoodsServicesDescription|text", "GoodsServicesDescription|languageCode"
        if text in flat.columns and lang in flat.columns:
            out[f"{main}.GoodsServices.Description"] = filter_equals(flat, lang, "en").select(
                *keys, q(text), q(lang)).dropDuplicates()
        else:
            out[f"{main}.GoodsServices.Description"] = empty(text, lang)
        return out
    return handler


def em_separation(main: str, key: str) -> SuffixSeparation:
    # landed tables carry the operation code beside the key; the merge drops it and matches on the key
    return SuffixSeparation(keys=("operationCode", key), main_table=main, how=EM_CLEAN, table_prefix=f"{main}.",
                            flag="operationCode", delete_literal="Delete",
                            special={"GoodsServicesDetails": _em_goods(main)})


def separate_em(df: DataFrame, main: str = "TradeMark", key: str = "ApplicationNumber",
                record_column: str | None = None) -> dict[str, DataFrame]:
    """Narrow to the main record, flatten once, clean names, split by suffix."""
    if record_column is not None:  # P12: narrow to the record container, walk down to the records
        df = flatten_once(df.select(q(record_column)))
        while len(df.columns) == 1 and is_container(df.schema.fields[0].dataType):
            df = flatten_once(df)
        df = clean_names(df, EM_NAMES, record_column)
    if "operationCode" not in df.columns:  # a version without any flagged record
        df = df.withColumn("operationCode", F.lit(None).cast("string"))
    return separate_by_suffix(df, em_separation(main, key))


def em_spec(schema: str = "TradeMark") -> OfficeSpec:
    """One EM schema: its row element, main table and key (own ledger schema)."""
    key = EM_SCHEMA_KEYS[schema]
    return OfficeSpec(
        office="em", row_tag=EM_ROW_TAGS[schema], keys=(key,),
        separate=lambda df: separate_em(clean_names(df, EM_NAMES), main=schema, key=key),
        flag="operationCode", delete_literal="Delete", dedupe_at_merge=True,
        helper_columns=("operationCode",), schemas=(schema,), type_rules=tuple(ISO_TYPE_RULES))


# Main table and key per EM schema.
EM_SCHEMA_KEYS = {"TradeMark": "ApplicationNumber", "InternationalRegistration": "ApplicationNumber",
                  "Applicant": "ApplicantIdentifier"}
# Record element per EM schema (international registrations come as trade marks).
EM_ROW_TAGS = {"TradeMark": "TradeMark", "InternationalRegistration": "TradeMark", "Applicant": "Applicant"}

EM = OfficeSpec(
    office="em", row_tag="TradeMark", keys=("ApplicationNumber",), separate=separate_em,
    flag="operationCode", delete_literal="Delete", dedupe_at_merge=True,
    helper_columns=("operationCode",), type_rules=tuple(ISO_TYPE_RULES),
    schemas=("TradeMark", "InternationalRegistration", "Applicant"),
)

# ------------------------------------------------------------------ GB -----
GB_CLEAN = Cleaning(GB_NAMES, GB_DROP, tuple(GB_TYPE_RULES), distinct=False, null_rule="all")
GB_KEYS = ("ApplicationNumber",)


def separate_gb(df: DataFrame) -> dict[str, DataFrame]:
    spec = SuffixSeparation(keys=GB_KEYS, main_table="Application", how=GB_CLEAN,
                            strip_suffix_in_name=False, strip_table_prefix=False,
                            skip=("MarkImageDetails",))
    df = clean_names(df, GB_NAMES)
    out = separate_by_suffix(df, spec)
    # GB keeps rows that are non-null anywhere, keys included.
    return out


GB = OfficeSpec(office="gb", row_tag="TradeMark", keys=GB_KEYS, separate=separate_gb,
                publish_folder="closed", always_publish=True, type_rules=tuple(GB_TYPE_RULES))

OFFICES = {"us": US, "ca": CA, "em": EM, "gb": GB}


def normalise(spec: OfficeSpec, records: DataFrame) -> dict[str, DataFrame]:
    """One version's nested records -> its table family (lazy)."""
    return spec.separate(records)


def prepare_new_rows(spec: OfficeSpec, table: str, new: DataFrame) -> DataFrame:
    """P3 + D1 before a merge: drop helper columns, then dedupe where the
    office does (CA/EM every table, US classifications only, GB never)."""
    new = drop_present(new, spec.helper_columns)
    dd = spec.dedupe_at_merge
    if dd is True or (isinstance(dd, tuple) and table in dd):
        new = new.dropDuplicates()
    return new
