"""Typed parsing of raw text columns.

Each validator takes a STRING column and returns ``(value, reason)``: the typed
value (the sentinel when the input is NULL) and a reject reason that is NULL
when the text is acceptable.  Both are plain column expressions, so a whole
table contract becomes one ``select`` that stays inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the source system's behaviour.
# Missing integers become -9999 and missing floats -999.999; the literal
# sentinel text is itself accepted by the validators.
INT_SENTINEL = -9999
FLOAT_SENTINEL = -999.999
STRICT_INT_PATTERN = r"^[0-9]+$"
STRICT_FLOAT_PATTERN = r"^[0-9]+\.?[0-9]*$"
# Amounts are kept as DECIMAL(38,18) by the source database: 20 digits before the point.
FLOAT_LIMIT = 1e20
INT_SENTINEL_TEXT = "-9999"
FLOAT_SENTINEL_TEXT = "-999.999"

SIGNED_INT_PATTERN = r"^[+-]?[0-9]+$"

# What counts as "numeric text" for id columns that are read as numbers
# (optional sign, digits with an optional fraction, optional exponent).
NUMERIC_PATTERN = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"

_INT_TYPES = {"int": "INT", "integer": "INT", "bigint": "BIGINT", "long": "BIGINT"}


def _int_type(dtype: str) -> str:
    return _INT_TYPES.get(dtype.lower(), dtype.upper())


def strict_int(c: Column, dtype: str = "INT", default: int = INT_SENTINEL,
               label: str = "value") -> tuple[Column, Column]:
    """Digits only (no sign, no fraction); NULL -> ``default``.

    Text that matches but does not fit ``dtype`` is rejected rather than
    wrapped or truncated.
    """
    t = _int_type(dtype)
    ok_text = c.rlike(STRICT_INT_PATTERN) | (c == F.lit(INT_SENTINEL_TEXT))
    typed = c.try_cast(t)
    value = F.when(c.isNull(), F.lit(default).cast(t)).when(ok_text, typed)
    reason = (
        F.when(c.isNull(), F.lit(None).cast("string"))
        .when(~ok_text, F.lit(f"{label}:not_integer"))
        .when(typed.isNull(), F.lit(f"{label}:out_of_range"))
    )
    return value, reason


def signed_int(c: Column, dtype: str = "INT", label: str = "value") -> tuple[Column, Column]:
    """Integer text with an optional sign; NULL stays NULL.  Read as BIGINT,
    and rejected if it does not fit ``dtype``."""
    ok_text = c.rlike(SIGNED_INT_PATTERN)
    value = F.when(ok_text, c.try_cast("BIGINT").try_cast(_int_type(dtype)))
    reason = (
        F.when(c.isNull(), F.lit(None).cast("string"))
        .when(~ok_text, F.lit(f"{label}:not_integer"))
        .when(value.isNull(), F.lit(f"{label}:out_of_range"))
    )
    return value, reason


def numeric_int(c: Column, dtype: str = "INT", default: int = INT_SENTINEL,
                label: str = "value") -> tuple[Column, Column]:
    """Any numeric text, truncated toward zero (``862.0`` -> 862); NULL -> default."""
    t = _int_type(dtype)
    trimmed = F.trim(c)
    ok_text = trimmed.rlike(NUMERIC_PATTERN)
    typed = trimmed.try_cast("DOUBLE").try_cast(t)
    value = F.when(c.isNull(), F.lit(default).cast(t)).when(ok_text, typed)
    reason = (
        F.when(c.isNull(), F.lit(None).cast("string"))
        .when(~ok_text, F.lit(f"{label}:not_numeric"))
        .when(typed.isNull(), F.lit(f"{label}:out_of_range"))
    )
    return value, reason


def strict_float(c: Column, default: float = FLOAT_SENTINEL,
                 label: str = "value") -> tuple[Column, Column]:
    """Unsigned decimal text without exponent (``1.`` ok; ``.5``, ``1e6``, ``-1``
    rejected), below ``FLOAT_LIMIT``."""
    ok_text = c.rlike(STRICT_FLOAT_PATTERN) | (c == F.lit(FLOAT_SENTINEL_TEXT))
    typed = c.try_cast("DOUBLE")
    value = F.when(c.isNull(), F.lit(default).cast("double")).when(ok_text, typed)
    reason = (
        F.when(c.isNull(), F.lit(None).cast("string"))
        .when(~ok_text, F.lit(f"{label}:not_decimal"))
        .when(typed.isNull() | F.isnan(typed) | (F.abs(typed) >= F.lit(FLOAT_LIMIT)),
              F.lit(f"{label}:out_of_range"))
    )
    return value, reason
