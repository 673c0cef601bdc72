"""Strict date parsing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: year-month-day with optional zero padding on month and day.
YMD_SHAPE = r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$"


def parse_ymd_date(c: Column) -> Column:
    """``yyyy-M-d`` text -> DATE; anything else (padding, suffixes,
    impossible dates) -> NULL.  Never raises under ANSI mode."""
    return F.when(c.rlike(YMD_SHAPE), F.try_to_date(c, "yyyy-M-d"))
