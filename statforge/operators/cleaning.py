"""Declarative cleaning: a table is described by column rules and cleaned in one ``select``."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statforge.functions import expr as E
from statforge.operators.dedup import drop_repeats

INGESTED_AT = "bronze_ingestion_timestamp"
SOURCE_FILE = "bronze_source_file"
CLEANED_AT = "silver_processed_timestamp"


@dataclass(frozen=True)
class Rule:
    """One output column, computed from the raw table (whose schema tells the input type)."""

    name: str
    build: Callable[[T.StructType], Column]
    # Typed before duplicates are looked for: '01' and '1' are one id.
    early: bool = False


def keep(*names: str) -> list[Rule]:
    return [Rule(n, lambda _, n=n: F.col(n)) for n in names]


def ident(*names: str) -> list[Rule]:
    """Whole-number ids; unreadable ones are NULL."""
    return [Rule(n, lambda s, n=n: F.col(n) if isinstance(s[n].dataType, T.LongType) else F.col(n).try_cast("bigint"), True) for n in names]


def key_day(*names: str) -> list[Rule]:
    """Dates that are part of a key."""
    return [Rule(n, lambda s, n=n: E.lenient_date(n, s[n].dataType), True) for n in names]


def text(*names: str, to: str | None = None, default: str | None = None, upper: bool = False) -> list[Rule]:
    return [Rule(to or n, lambda _, n=n: E.text(n, default, upper)) for n in names]


def first_of(name: str, *candidates: str) -> list[Rule]:
    return [Rule(name, lambda _: E.first_text(*candidates))]


def count(*names: str) -> list[Rule]:
    """Whole numbers; unreadable or missing ones are 0."""
    return [Rule(n, lambda s, n=n: E.int_or_zero(n, s[n].dataType)) for n in names]


def number(*names: str, default: float) -> list[Rule]:
    return [Rule(n, lambda _, n=n: F.coalesce(E.lenient_double(n), F.lit(default))) for n in names]


def day(*names: str, to: str | None = None) -> list[Rule]:
    return [Rule(to or n, lambda s, n=n: E.lenient_date(n, s[n].dataType)) for n in names]


def centimetres(name: str) -> list[Rule]:
    return [Rule(name, lambda _: E.height_cm(name))]


@dataclass(frozen=True)
class CleanSpec:
    """``unique`` names raw key columns (one survivor each, before any trimming); ``required`` names
    output columns that may not be NULL; ``passthrough`` keeps raw columns no rule mentions."""

    rules: tuple[Rule, ...]
    required: tuple[str, ...] = ()
    unique: tuple[str, ...] = ()
    passthrough: bool = False
    # Raw columns not to use when picking the survivor of equal keys.
    unordered: tuple[str, ...] = field(default=(INGESTED_AT, SOURCE_FILE))


def spec(*groups: Iterable[Rule], **options) -> CleanSpec:
    return CleanSpec(tuple(rule for group in groups for rule in group), **options)


def clean(raw: DataFrame, table: CleanSpec, audit: bool = True) -> DataFrame:
    """Apply ``table`` to ``raw``. With ``audit``, carry the ingest time and add the cleaning time."""
    typed = {rule.name: rule.build(raw.schema) for rule in table.rules if rule.early}
    raw = raw.withColumns(typed) if typed else raw
    schema = raw.schema
    built = {rule.name: rule.build(schema) for rule in table.rules}
    rows = raw
    # Required columns are tested on the raw rows: the filter reaches the scan, and rows with a NULL
    # key (dropped in any case) do not meet in one task of the dedup.
    for name in table.required:
        rows = rows.where(built[name].isNotNull())
    if table.unique:
        rows = drop_repeats(rows, table.unique, skip=[c for c in table.unordered if c in raw.columns])
    if table.passthrough:
        out = [built.pop(f.name).alias(f.name) if f.name in built else F.col(f"`{f.name}`") for f in schema.fields]
    else:
        out = []
    out += [column.alias(name) for name, column in built.items()]
    if audit:
        if INGESTED_AT in raw.columns and not table.passthrough:
            out.append(F.col(INGESTED_AT))
        out.append(F.current_timestamp().alias(CLEANED_AT))
    return rows.select(*out)
