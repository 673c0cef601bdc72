"""Contract-driven cleaning: one pass, valid rows and rejects side by side.

For every contract column we build a typed expression and a reject-reason
expression (see :mod:`marquee.functions.validators`).  The reasons are gathered
into one array per row; a row is valid when the array is empty.  Everything is
a chain of narrow projections (JSON lists are parsed first, once per row) —
no shuffle, no driver round trip — and the caller gets both halves lazily, so
valid + rejects always equals the input.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee import contracts as K
from marquee.functions.dates import parse_ymd_date
from marquee.functions.jsoncols import with_json_lists
from marquee.functions.text import strip_leading_chars
from marquee.functions.validators import numeric_int, signed_int, strict_float, strict_int
from marquee.sources.csv import BLOCK, FILE, MALFORMED

REASONS = "reject_reasons"
# A reject's file and the byte range of it that the row begins in, where the reader told them.
PLACE = {FILE: "file", BLOCK: "block"}


@dataclass
class Cleaned:
    valid: DataFrame     # contract columns, typed
    rejects: DataFrame   # raw source columns + file and block, if known + reject_reasons (non-empty)
    annotated: DataFrame  # typed columns + raw columns + reasons, every row


def _raw(col: K.Col):
    return F.col(f"`{col.source}`").cast("string")


def _typed(col: K.Col):
    raw = _raw(col)
    if col.strip_leading:
        raw = strip_leading_chars(raw, col.strip_leading)
    if col.kind == K.STRICT_INT:
        return strict_int(raw, col.dtype, col.default, col.name)
    if col.kind == K.SIGNED_INT:
        return signed_int(raw, col.dtype, col.name)
    if col.kind == K.NUMERIC_INT:
        return numeric_int(raw, col.dtype, col.default, col.name)
    if col.kind == K.STRICT_FLOAT:
        return strict_float(raw, col.default, col.name)
    if col.kind == K.DATE:
        return parse_ymd_date(raw), F.lit(None).cast("string")
    if col.kind == K.JSON_LIST:
        return F.col(f"__json_{col.name}"), F.col(f"__json_{col.name}__reason")
    value = raw if col.dtype == "string" else raw.try_cast(col.dtype)
    if col.default is not None:
        value = F.coalesce(value, F.lit(col.default).cast(col.dtype))
    return value, F.lit(None).cast("string")


def annotate(df: DataFrame, contract: K.TableContract) -> DataFrame:
    """Raw columns -> typed contract columns + ``reject_reasons`` array."""
    specs = [(_raw(c), f"__json_{c.name}", c.default or "[]", c.name)
             for c in contract.columns if c.kind == K.JSON_LIST]
    if specs:
        df = with_json_lists(df, specs)
    typed, reasons = [], []
    for col in contract.columns:
        value, reason = _typed(col)
        typed.append(value.alias(col.name))
        if not col.nullable:
            reason = F.coalesce(reason, F.when(value.isNull(), F.lit(f"{col.name}:null")))
        reasons.append(reason)
    if MALFORMED in df.columns:
        reasons.append(F.when(F.col(MALFORMED).isNotNull(), F.lit("row:malformed")))
    raw = [F.col(f"`{c}`").cast("string").alias(f"raw_{c}") for c in dict.fromkeys(contract.sources)]
    # array_except drops the NULLs (no lambda, so the select stays codegen'd);
    # reasons are distinct by construction, so its de-duplication is moot.
    no_reason = F.array(F.lit(None).cast("string"))
    place = [F.col(c).alias(name) for c, name in PLACE.items() if c in df.columns]
    return df.select(*typed, *raw, *place, F.array_except(F.array(*reasons), no_reason).alias(REASONS))


def add_missing_columns(df: DataFrame, contract: K.TableContract) -> DataFrame:
    """Column defaults: a contract column absent from the input is added as
    NULL text, which its validator then turns into the column's default
    (``[]`` for JSON lists, NULL for dates, the sentinel for numbers).
    A NOT NULL column without a default cannot be defaulted."""
    missing = [c for c in contract.columns if c.source not in df.columns]
    bad = [c.source for c in missing if not c.nullable and c.default is None]
    if bad:
        raise ValueError(f"{contract.name}: input lacks required columns {bad}")
    return df.withColumns({c.source: F.lit(None).cast("string") for c in missing}) if missing else df


def apply_contract(df: DataFrame, contract: K.TableContract, distinct: bool = True) -> Cleaned:
    """Validate, type and fill ``df`` against ``contract``.

    ``valid`` keeps the contract columns of rows without reasons, de-duplicated
    over all columns when ``distinct`` (full-row distinct runs after typing, as
    the source system did).  ``rejects`` keeps the raw text and the reasons.
    Columns the input lacks take their defaults (``add_missing_columns``).
    """
    df = add_missing_columns(df, contract)
    return split_annotated(annotate(df, contract), contract, distinct)


def split_annotated(ann: DataFrame, contract: K.TableContract, distinct: bool = True) -> Cleaned:
    """Valid rows and rejects of an annotated frame.  When both halves are
    written, write ``ann`` once first and split the written copy, so the
    parsing is not done twice."""
    valid = ann.filter(F.size(REASONS) == 0).select(*contract.names)
    if distinct:
        valid = valid.dropDuplicates()
    raw_cols = [f"raw_{c}" for c in dict.fromkeys(contract.sources)]
    place = [c for c in PLACE.values() if c in ann.columns and c not in contract.names]
    rejects = ann.filter(F.size(REASONS) > 0).select(*raw_cols, *place, REASONS)
    return Cleaned(valid=valid, rejects=rejects, annotated=ann)


def reject_rows(cleaned: Cleaned, key: str) -> DataFrame:
    """One row per (raw key, reason), with the row's file where it is known —
    the quarantine report."""
    place = [c for c in PLACE.values() if c in cleaned.rejects.columns]
    return cleaned.rejects.select(F.col(f"raw_{key}").alias("raw_key"), F.explode(REASONS).alias("reason"), *place)
