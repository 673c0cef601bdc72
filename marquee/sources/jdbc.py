"""JDBC source and sink.

Reads are parallel when a numeric ``partition_column`` and its bounds are
given (``numPartitions`` range queries), and a derived table
``(SELECT ...) AS t`` lets the database do a join before Spark reads it.
Filters and projections applied to the returned DataFrame are pushed into
the database query by Spark.  Credentials come from the caller.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_jdbc(spark: SparkSession, url: str, table: str | None = None,
              query: str | None = None, properties: dict | None = None,
              partition_column: str | None = None, lower_bound: int | None = None,
              upper_bound: int | None = None, num_partitions: int | None = None,
              fetchsize: int = 10_000) -> DataFrame:
    if (table is None) == (query is None):
        raise ValueError("give exactly one of table / query")
    source = table if table is not None else f"({query}) AS q"
    props = dict(properties or {})
    props.setdefault("fetchsize", str(fetchsize))
    if partition_column:
        if None in (lower_bound, upper_bound, num_partitions):
            raise ValueError("partitioned read needs bounds and num_partitions")
        return spark.read.jdbc(url, source, column=partition_column, lowerBound=lower_bound,
                               upperBound=upper_bound, numPartitions=num_partitions,
                               properties=props)
    return spark.read.jdbc(url, source, properties=props)


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "overwrite",
               properties: dict | None = None, truncate: bool = True,
               batchsize: int = 10_000, num_partitions: int | None = None) -> None:
    """Write in parallel (one connection per task, capped by ``num_partitions``).

    ``truncate`` keeps the target's DDL on overwrite instead of dropping it
    (dropping would lose keys and checks).
    """
    props = dict(properties or {})
    props["truncate"] = "true" if truncate else "false"
    props["batchsize"] = str(batchsize)
    if num_partitions:
        props["numPartitions"] = str(num_partitions)
    df.write.jdbc(url, table, mode=mode, properties=props)
