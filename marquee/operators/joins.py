"""Joins whose small side is measured before it is broadcast.

A side is broadcast only when its measured size is below a limit; beyond it
the join is left to the planner (sort-merge join, with AQE's skew handling).
The measurement is one aggregation over the small side, so that side should
be cheap to evaluate (already filtered or materialized).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, BinaryType, MapType, StringType, StructType)

# Default ceiling for an explicit broadcast (bytes of column data).
BROADCAST_MAX_BYTES = 64 * 1024 * 1024
_FIXED_OVERHEAD = 16  # per row, hashed-relation bookkeeping
_FIXED_WIDTH = {"boolean": 1, "byte": 1, "short": 2, "integer": 4, "long": 8, "float": 4,
                "double": 8, "date": 4, "timestamp": 8, "timestamp_ntz": 8, "decimal": 16}


def measured_bytes(df: DataFrame) -> int:
    """Exact column bytes of ``df``: string/binary lengths plus fixed widths."""
    parts = [F.lit(_FIXED_OVERHEAD)]
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (StringType, BinaryType)):
            parts.append(F.coalesce(F.octet_length(c), F.lit(0)))
        elif isinstance(f.dataType, (ArrayType, MapType, StructType)):
            parts.append(F.coalesce(F.octet_length(F.to_json(c)), F.lit(0)))
        else:
            parts.append(F.lit(_FIXED_WIDTH.get(f.dataType.typeName(), 16)))
    total = df.agg(F.sum(sum(parts[1:], parts[0]).cast("long")).alias("b")).first()["b"]
    return int(total or 0)


def join_small_side(big: DataFrame, small: DataFrame, on, how: str = "inner",
                    max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """``big.join(small, on, how)``, broadcasting ``small`` only if it measures
    at most ``max_bytes``."""
    if measured_bytes(small) <= max_bytes:
        small = F.broadcast(small)
    return big.join(small, on, how)
