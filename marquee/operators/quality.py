"""Table constraints as data-quality jobs.

The source system let the database refuse a whole load.  Here every declared
constraint becomes a query that lists the offending keys, so a load can be
checked (and the offenders quarantined) before it is published:

* PRIMARY KEY  -> NULL key parts, and keys held by more than one row
* UNIQUE       -> keys held by more than one row (rows with a NULL part skip,
                  as NULLs are distinct in SQL UNIQUE)
* NOT NULL     -> rows with NULL in the column
* CHECK        -> rows where the predicate is false (NULL passes)

Output columns: ``constraint`` STRING, ``key`` STRING, ``num_rows`` BIGINT.
All row-level checks share one pass over the table.  All key checks share one
shuffle: each row is expanded to a hash of each (constraint, key), which are
counted, partially in tasks; only rows whose hash occurs repeatedly are
looked at again, with their real keys.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.contracts import TableContract
from marquee.operators.joins import join_small_side
from marquee.session import materialize


def key_text(cols: list[str]) -> Column:
    """Key parts as ``a|b|c`` text, ``NULL`` spelled out."""
    return F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("NULL")) for c in cols])


def declared_keys(contract: TableContract) -> list[tuple[str, list[str]]]:
    """(label, columns) of the primary key and the unique keys."""
    primary = [("primary_key_duplicate", list(contract.primary_key))] if contract.primary_key else []
    return primary + [("unique:" + ",".join(cols), list(cols)) for cols in contract.unique]


def key_rows(df: DataFrame, contract: TableContract, text: bool = True) -> DataFrame:
    """A row for each row and declared key without a NULL part: ``constraint``,
    the key's hash ``h1``, ``h2`` and, with ``text``, the key as it is shown
    (``key``) and as text that no other key has (``exact``)."""
    own = []
    for i, (label, cols) in enumerate(declared_keys(contract)):
        parts = [F.lit(label).alias("constraint"), F.xxhash64(F.lit(i), *cols).alias("h1"), F.xxhash64(*cols, F.lit(-1 - i)).alias("h2")]
        if text:
            exact = F.struct(*[F.col(c).alias(str(n)) for n, c in enumerate(cols)])
            parts += [key_text(cols).alias("key"), F.to_json(exact, {"ignoreNullFields": "false"}).alias("exact")]
        own.append(F.when(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols]), F.struct(*parts)))
    return df.select(F.explode(F.array_compact(F.array(*own))).alias("k")).select("k.*")


def _duplicates(df: DataFrame, contract: TableContract) -> DataFrame:
    counted = key_rows(df, contract, text=False).groupBy("h1").agg(F.count(F.lit(1)).alias("n"))
    repeated = materialize(counted.filter("n > 1").select("h1"), "repeated-keys")
    rows = join_small_side(key_rows(df, contract), repeated, "h1", "left_semi")
    return (rows.groupBy("constraint", "exact").agg(F.first("key").alias("key"), F.count(F.lit(1)).alias("num_rows"))
            .filter(F.col("num_rows") > 1).select("constraint", "key", "num_rows"))


def _row_level(df: DataFrame, checks: list[tuple[str, Column]], key_cols: list[str]) -> DataFrame:
    """All row-level checks in one pass: each row carries the labels of the
    checks it fails; rows failing none are dropped before the explode."""
    labels = F.array_except(
        F.array(*[F.when(pred, F.lit(label)) for label, pred in checks]),
        F.array(F.lit(None).cast("string")))
    tagged = df.select(key_text(key_cols).alias("key"), labels.alias("labels"))
    return tagged.filter(F.size("labels") > 0).select(
        F.explode("labels").alias("constraint"), "key", F.lit(1).cast("bigint").alias("num_rows"))


def row_violations(df: DataFrame, contract: TableContract) -> DataFrame | None:
    """Violations that a row has by itself; None if the contract has no such
    constraint."""
    pk = list(contract.primary_key) or [contract.columns[0].name]
    checks: list[tuple[str, Column]] = []
    if contract.primary_key:
        checks.append(("primary_key_null", reduce(lambda a, b: a | b, [F.col(c).isNull() for c in pk])))
    checks += [(f"not_null:{c.name}", F.col(c.name).isNull()) for c in contract.columns if not c.nullable]
    checks += [(f"check:{chk.name}", F.coalesce(~F.expr(chk.sql), F.lit(False))) for chk in contract.checks]
    return _row_level(df, checks, pk) if checks else None


def constraint_violations(df: DataFrame, contract: TableContract) -> DataFrame:
    """Union of every violated constraint of ``contract`` found in ``df``.
    Keys are counted when this is called."""
    rows = row_violations(df, contract)
    parts = [rows] if rows is not None else []
    if declared_keys(contract):
        parts.append(_duplicates(df, contract))
    return reduce(lambda a, b: a.unionByName(b), parts)
