"""Aggregates: group mean, counts, duplicate-value groups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def mean_rating(ratings: DataFrame, key: str = "movie_id", value: str = "rating",
                digits: int = 1, out: str = "rating", count_out: str | None = None) -> DataFrame:
    """Per-key mean rounded half-up to ``digits`` (NULL ratings are ignored),
    plus the number of rating rows as ``count_out`` if given.

    Planned as partial + final hash aggregation: a key held by a third of the
    rows is reduced to one (sum, count) pair per task before the shuffle.
    """
    aggs = [F.round(F.avg(value), digits).alias(out)]
    if count_out:
        aggs.append(F.count(F.lit(1)).alias(count_out))
    return ratings.groupBy(key).agg(*aggs)


#: Holds any sum of ratings exactly, so merging parts in any order gives the same mean.
TOTAL_TYPE = "decimal(38,6)"


def mean_state(ratings: DataFrame, key: str = "movie_id", value: str = "rating") -> DataFrame:
    """What means of parts can be merged from: ``key``, the exact ``total`` and
    the number ``n`` of its ratings (NULLs counted as none)."""
    return ratings.groupBy(key).agg(
        F.coalesce(F.sum(F.col(value).cast("decimal(24,6)")), F.lit(0)).cast(TOTAL_TYPE).alias("total"), F.count(value).alias("n"))


def merged_states(a: DataFrame, b: DataFrame, key: str = "movie_id") -> DataFrame:
    """The state of both parts' rows."""
    return a.unionByName(b).groupBy(key).agg(F.sum("total").cast(TOTAL_TYPE).alias("total"), F.sum("n").alias("n"))


def state_means(state: DataFrame, digits: int = 1, out: str = "rating") -> DataFrame:
    """Means of a state, rounded half-up; NULL for keys without a rating."""
    mean = F.when(F.col("n") > 0, F.round(F.col("total").cast("double") / F.col("n"), digits))
    return state.select(*[c for c in state.columns if c not in ("total", "n")], mean.alias(out))


def row_count(df: DataFrame, out: str = "num_rows") -> DataFrame:
    """``SELECT count(1)`` — one row."""
    return df.agg(F.count(F.lit(1)).alias(out))


def value_groups(df: DataFrame, col: str, min_count: int = 2,
                 out: str = "num_rec") -> DataFrame:
    """Values of ``col`` carried by at least ``min_count`` rows, with their count
    (``SELECT v, count(1) n ... GROUP BY v`` filtered on ``n``)."""
    counted = df.groupBy(col).agg(F.count(F.lit(1)).alias(out))
    return counted.filter(F.col(out) >= min_count)


def empty_like(df: DataFrame) -> DataFrame:
    """``WHERE 1 = 2``: the schema with no rows (Catalyst folds it to an empty
    relation, so nothing is scanned)."""
    return df.filter(F.lit(False))
