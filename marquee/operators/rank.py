"""Ranking, top-k and top-n.

``dense_top_k`` keeps every row whose value is among the ``k`` largest
*distinct* values (``DENSE_RANK() OVER (ORDER BY v DESC) <= k`` with all ties).
A window without PARTITION BY sends every row through one task; instead:

1. the ``k``-th best distinct value of a part of the values (those whose hash
   falls into one of ``BOUND_PARTS`` classes) bounds the ``k``-th best of all;
   if the part has so many, only values up to that bound go on, and a filter
   on a scanned column reaches the file statistics;
2. ``select v`` -> ``distinct`` (partial aggregation collapses hot values
   map-side, so a value held by a third of the rows costs one row per task);
3. ``orderBy(v desc).limit(k)`` -> ``TakeOrderedAndProject`` over what the
   bound left;
4. number those ``k`` values (their rank is their position: they are distinct);
5. broadcast-join them back null-safely.  The broadcast side holds at most
   ``k`` rows; of types without a fixed width it is measured first.  Beyond
   ``BROADCAST_MAX_BYTES`` the join is left to the planner (sort-merge / AQE).

The big input is never sorted globally and never funnelled into one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType, BinaryType, NumericType, StringType

from marquee.operators.joins import BROADCAST_MAX_BYTES, join_small_side

# A (value, rank) row of fixed width in the hashed relation.
_ROW_BYTES = 32
# Classes of values, one of which bounds the rest.
BOUND_PARTS = 64

_V, _R = "__topk_value", "__topk_rank"


def _order(c: Column, descending: bool) -> Column:
    return c.desc_nulls_last() if descending else c.asc_nulls_last()


def ranked_top_values(df: DataFrame, col: str, k: int, descending: bool = True) -> DataFrame:
    """The ``k`` best distinct values of ``col`` with their dense rank (<= k rows)."""
    if k < 1:
        raise ValueError("k must be >= 1")
    values = df.select(F.col(col).alias(_V))
    bound = _bound(values, k, descending)
    if bound is not None:
        limit = F.lit(bound).cast(values.schema[_V].dataType)
        values = values.filter(F.col(_V) >= limit if descending else F.col(_V) <= limit)
    top = values.distinct().orderBy(_order(F.col(_V), descending)).limit(k)
    return top.withColumn(_R, F.row_number().over(Window.orderBy(_order(F.col(_V), descending))))


def _bound(values: DataFrame, k: int, descending: bool):
    """A value that the ``k`` best distinct ones reach, or None.  The k-th best
    of any part of the values is one; NULLs, which sort last, are left out."""
    part = values.filter(F.col(_V).isNotNull() & (F.pmod(F.xxhash64(_V), F.lit(BOUND_PARTS)) == 0)).distinct()
    best = part.orderBy(_order(F.col(_V), descending)).limit(k)
    n, last = best.agg(F.count("*"), F.min(_V) if descending else F.max(_V)).first()
    return last if n == k else None


def dense_top_k(df: DataFrame, col: str, k: int, descending: bool = True,
                rank_col: str | None = None, materialize_input: bool = False) -> DataFrame:
    """Rows of ``df`` whose ``col`` is among the ``k`` best distinct values.

    Output: the columns of ``df`` (plus ``rank_col`` holding the dense rank,
    if given).  NULL sorts last in both directions, as in Spark SQL.

    ``df`` is read three times (bound, values, rows); the bound is found while
    the result is being built.  When it is expensive to
    produce (joins/aggregates), pass ``materialize_input=True`` to write it
    once as Parquet under the checkpoint dir; the values pass then reads only
    the ranked column.
    """
    if materialize_input:
        from marquee.session import materialize
        df = materialize(df, "topk-input")
    ranked = ranked_top_values(df, col, k, descending)
    on = df[col].eqNullSafe(ranked[_V])
    if isinstance(df.schema[col].dataType, (AtomicType, NumericType)) and not isinstance(
            df.schema[col].dataType, (StringType, BinaryType)):
        joined = df.join(F.broadcast(ranked) if k * _ROW_BYTES <= BROADCAST_MAX_BYTES else ranked, on, "inner")
    else:
        joined = join_small_side(df, ranked, on)
    out = [df[c] for c in df.columns]
    if rank_col:
        out.append(ranked[_R].cast("int").alias(rank_col))
    return joined.select(*out)


def dense_top_k_window(df: DataFrame, col: str, k: int, descending: bool = True,
                       rank_col: str | None = None) -> DataFrame:
    """The textbook window form, kept as the oracle for ``dense_top_k``."""
    w = Window.orderBy(_order(F.col(col), descending))
    r = rank_col or _R
    out = df.withColumn(r, F.dense_rank().over(w)).filter(F.col(r) <= k)
    return out if rank_col else out.drop(_R)


def top_n(df: DataFrame, n: int, *order: Column) -> DataFrame:
    """``ORDER BY ... LIMIT n`` (planned as ``TakeOrderedAndProject``).

    Callers should end ``order`` with a unique key so ties cannot make the
    result depend on task timing.
    """
    return df.orderBy(*order).limit(n)
