"""Parquet tables: driver inputs and contract-shaped outputs."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.contracts import TableContract
from marquee.session import delete_path, make_folder, materialize, move_path, path_exists

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
                 "events", "documents", "embeddings", "pages", "benchmark", "labels",
                 "conversations")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def register_views(spark: SparkSession, sf_dir: str, names=DRIVER_TABLES) -> None:
    """Expose tables to ``spark.sql`` by name; replaces views of those names.
    The library itself passes frames to ``spark.sql`` and makes no views."""
    for n in names:
        read_table(spark, sf_dir, n).createOrReplaceTempView(n)


def conform(df: DataFrame, contract: TableContract) -> DataFrame:
    """Select the contract's columns in order, cast to the contract types."""
    return df.select(*[F.col(c.name).cast(c.dtype).alias(c.name) for c in contract.columns])


def write_table(df: DataFrame, path: str, contract: TableContract | None = None,
                mode: str = "overwrite") -> None:
    """Replace (``overwrite``) or extend (``append``) a Parquet table.

    With a contract the frame is conformed first, so an append can never
    change the table's schema.  A table is replaced when its successor, written
    beside it, is complete: a job that fails leaves the old one, and ``df`` may
    read it.
    """
    if mode not in ("overwrite", "append"):
        raise ValueError(mode)
    out = conform(df, contract) if contract else df
    if mode == "append":
        out.write.mode(mode).parquet(path)
        return
    path = path.rstrip("/")
    successor = f"{path}__incoming-{uuid.uuid4().hex[:8]}"
    try:
        out.write.parquet(successor)
    except Exception:
        delete_path(df.sparkSession, successor)
        raise
    _put(df.sparkSession, successor, path)


def _put(spark: SparkSession, successor: str, path: str) -> None:
    """Put a written folder in a table's place."""
    old = f"{successor}-old"
    if path_exists(spark, path):
        move_path(spark, path, old)
    else:
        parent = path.rsplit("/", 1)[0]
        if parent and not path_exists(spark, parent):
            make_folder(spark, parent)
    move_path(spark, successor, path)
    delete_path(spark, old)


def replace_tables(spark: SparkSession, path: str, tables: dict[str, DataFrame]) -> None:
    """Replace a folder of tables by others at once: all are written beside it
    before any takes its place."""
    path = path.rstrip("/")
    successor = f"{path}__incoming-{uuid.uuid4().hex[:8]}"
    try:
        for name, df in tables.items():
            df.write.parquet(f"{successor}/{name}")
    except Exception:
        delete_path(spark, successor)
        raise
    _put(spark, successor, path)


# ---- keys beside a table ----------------------------------------------------

#: Parts of a table's key index, by hash.
KEY_PARTS = 256
#: Columns of the index; one with others is built anew.
INDEX = ["constraint", "h1", "exact", "part"]


def key_index(path: str) -> str:
    """The folder with the keys of a loaded table."""
    return f"{path.rstrip('/')}__keys"


def _indexed(df: DataFrame, contract: TableContract) -> DataFrame:
    from marquee.operators.quality import key_rows
    return key_rows(df, contract).withColumn("part", F.pmod("h1", F.lit(KEY_PARTS)).cast("int"))


def _ensure_index(spark: SparkSession, path: str, contract: TableContract) -> None:
    """An index that has as many primary keys as the table has rows (its files'
    footers tell) is up to date; else rows were written past ``load_table`` or
    a load was cut off, and the index is built anew."""
    index = key_index(path)
    if path_exists(spark, index):
        known = spark.read.parquet(index)
        label = known.select(F.min("constraint")).first()[0] if known.columns == INDEX else None  # primary_key_... comes before unique:...
        if known.filter(F.col("constraint") == label).count() == spark.read.parquet(path).count():
            return
    write_index(_indexed(spark.read.parquet(path), contract), index, "overwrite")


def write_index(keys: DataFrame, index: str, mode: str) -> None:
    """Keys dealt by part, so each part gets one file a load."""
    keys.select(*INDEX).repartition("part").write.mode(mode).partitionBy("part").parquet(index)


def known_keys(spark: SparkSession, path: str, batch: DataFrame) -> DataFrame:
    """Keys of ``batch`` (as ``_indexed`` gives them, written) that the table
    has.  Only the index's parts with keys of the batch are read, and none of
    the table's files."""
    parts = [r["part"] for r in batch.select("part").distinct().collect()]  # KEY_PARTS at most
    known = spark.read.parquet(key_index(path)).filter(F.col("part").isin(parts))
    same = ["constraint", "h1", "exact"]
    return batch.join(known.select(*same), same, "left_semi")


def append_violations(spark: SparkSession, new: DataFrame, keys: DataFrame, path: str, contract: TableContract) -> DataFrame:
    """Constraints that a batch would violate in a table that has none violated
    so far.  A key's ``num_rows`` counts the table's row too."""
    from marquee.operators.quality import row_violations
    mine = keys.groupBy("constraint", "exact").agg(F.first("key").alias("key"), F.count("*").alias("n"))
    known = known_keys(spark, path, keys).select("constraint", "exact").distinct().withColumn("held", F.lit(1))
    taken = (mine.join(known, ["constraint", "exact"], "left")
             .withColumn("num_rows", F.col("n") + F.coalesce("held", F.lit(0))).filter("num_rows > 1")
             .select("constraint", "key", "num_rows"))
    rows = row_violations(new, contract)
    return taken if rows is None else rows.unionByName(taken)


class ConstraintError(ValueError):
    """A load was refused because the result would violate table constraints."""

    def __init__(self, table: str, violations, incoming: str):
        self.violations = violations  # DataFrame of (constraint, key, num_rows)
        self.incoming = incoming  # the refused copy
        super().__init__(f"{table}: load refused, constraints violated")


def load_table(spark: SparkSession, df: DataFrame, path: str, contract: TableContract,
               mode: str = "append") -> None:
    """Load a batch as a whole or not at all.

    The conformed batch is computed once, into a folder beside the table; the
    contract's constraints are checked on that copy and, for an append, against
    the table's keys, which are kept in an index beside it (``key_index``);
    then that copy is published, and its keys are added.  A replaced table
    stays in place until its successor is complete.  If a constraint would be
    violated the table is left as it was and ``ConstraintError`` is raised with
    the violations, which read the refused copy; ``discard_refused`` deletes
    it.  One writer at a time: the tables here have no transaction log.
    """
    from marquee.operators.quality import constraint_violations, declared_keys

    if mode not in ("overwrite", "append"):
        raise ValueError(mode)
    path = path.rstrip("/")
    incoming = f"{path}__incoming-{uuid.uuid4().hex[:8]}"
    conform(df, contract).write.parquet(incoming)
    new = spark.read.parquet(incoming)
    indexed = bool(declared_keys(contract))
    append = mode == "append" and path_exists(spark, path)
    keys = _indexed(new, contract) if indexed else None
    if append and indexed:
        keys = materialize(keys, "batch-keys")  # read several times
        _ensure_index(spark, path, contract)
        violations = append_violations(spark, new, keys, path, contract)
    else:
        violations = constraint_violations(new, contract)
    if not violations.isEmpty():
        raise ConstraintError(contract.name, violations, incoming)
    if append:
        new.write.mode("append").parquet(path)
        delete_path(spark, incoming)
    else:
        _put(spark, incoming, path)
        keys = _indexed(spark.read.parquet(path), contract) if indexed else None
    if indexed:
        write_index(keys, key_index(path), "append" if append else "overwrite")


def discard_refused(spark: SparkSession, error: ConstraintError) -> None:
    delete_path(spark, error.incoming)
