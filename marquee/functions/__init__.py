"""Column expressions.  All are built-in Spark SQL functions except the one
Arrow-batched fallback in :mod:`marquee.functions.jsoncols`."""

from marquee.functions.dates import parse_ymd_date
from marquee.functions.jsoncols import (
    COMPANY_ARRAY,
    has_null_element,
    literal_to_json,
    with_json_lists,
)
from marquee.functions.ratio import guarded_ratio
from marquee.functions.text import clean_feed_title, strip_leading_chars
from marquee.functions.validators import (
    FLOAT_SENTINEL,
    INT_SENTINEL,
    numeric_int,
    strict_float,
    strict_int,
)

__all__ = [
    "COMPANY_ARRAY", "FLOAT_SENTINEL", "INT_SENTINEL",
    "clean_feed_title", "guarded_ratio", "has_null_element",
    "literal_to_json", "with_json_lists",
    "numeric_int", "parse_ymd_date", "strict_float", "strict_int",
    "strip_leading_chars",
]
