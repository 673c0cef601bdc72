"""Set operations: union by column name and full-row distinct."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame


def union_by_name(frames: list[DataFrame], allow_missing: bool = True) -> DataFrame:
    """Union-all aligning columns by name (not position)."""
    if not frames:
        raise ValueError("nothing to union")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), frames)


def distinct_rows(df: DataFrame) -> DataFrame:
    """Full-row distinct; NULLs compare equal.  Partial aggregation removes
    duplicates map-side before the shuffle."""
    return df.dropDuplicates()
