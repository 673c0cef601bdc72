"""Text cleaning expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the prefix the encyclopedia feed puts in front of every title.
FEED_TITLE_PREFIX = "Wikipedia:"


def strip_leading_chars(c: Column, chars: str) -> Column:
    """Remove every leading character that is in ``chars`` (``ttt01`` -> ``01``).

    This is character-set stripping, not prefix removal: it behaves like
    Python's ``str.lstrip(chars)``.
    """
    klass = "".join("\\" + ch if ch in "\\^]-[" else ch for ch in dict.fromkeys(chars))
    return F.regexp_replace(c, f"^[{klass}]+", "")


def clean_feed_title(c: Column) -> Column:
    """Drop the feed prefix (only at position 0), then trim spaces.

    Order matters: a leading space before the prefix keeps the prefix.
    """
    return F.trim(F.regexp_replace(c, "^" + FEED_TITLE_PREFIX, ""))
