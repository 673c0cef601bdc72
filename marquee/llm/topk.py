"""Exact top-k inner products by norm buckets.

Candidates are sorted by length and cut into buckets of vectors of similar
length, each one packed row with its greatest length.  Queries are packed in
blocks.  A first look at the longest bucket gives each query a lower bound of
its k-th best score.  For a pair of block and bucket that bound, divided by
the lengths of the query and of the bucket's longest vector, is the local
cosine threshold:

* above 1, no vector of the bucket can reach the bound: the pair is skipped;
* small, few vectors can be told apart by their directions: the bucket is
  pruned by length alone (its vectors are in order of length);
* else by coordinates: the product over the query's largest coordinates, plus
  the most that the rest can add (Cauchy-Schwarz), must reach the bound.

What survives is verified with exact integer products.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marquee.session import materialize

BUCKET_ROWS = 1024
BLOCK_ROWS = 256
LOW_COSINE = 0.15
FOCUS = 16
PACKED = "dim int, top double, ids binary, vectors binary"


def integer_vectors(df: DataFrame, id_col: str, vector_col: str, scale: int = 1024) -> DataFrame:
    """``vec_id``, ``v`` (each component x as floor(scale * x)), ``dim``,
    ``len2``.  Rows without an id, without a vector or any component, or with
    a null, NaN or infinite component take no part."""
    own = df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("x"))
    bad = F.exists("x", lambda e: e.isNull() | F.isnan(e) | (F.abs(e.cast("double")) == float("inf")))
    own = own.filter(F.col("vec_id").isNotNull() & (F.size("x") > 0)).filter(~bad)
    own = own.select("vec_id", F.transform("x", lambda e: F.floor(e.cast("double") * scale).cast("long")).alias("v"))
    return own.select("vec_id", "v", F.size("v").alias("dim"),
                      F.aggregate("v", F.lit(0.0), lambda a, e: a + e.cast("double") * e.cast("double")).alias("len2"))


def _pack(rows: int):
    """Packs runs of vectors of one dimension, in the order that they come."""
    def packed(ids: list, vectors: list) -> pa.RecordBatch:
        m = np.array(vectors, dtype=np.int64)
        top = float(np.sqrt((m.astype(float) ** 2).sum(axis=1)).max())
        return pa.RecordBatch.from_pydict({
            "dim": pa.array([m.shape[1]], pa.int32()), "top": [top],
            "ids": [np.array(ids, dtype=np.int64).tobytes()], "vectors": [m.tobytes()]})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, vectors = [], []
        for batch in batches:
            for i, v in zip(batch.column("vec_id").to_pylist(), batch.column("v").to_pylist()):
                if ids and (len(ids) == rows or len(v) != len(vectors[0])):
                    yield packed(ids, vectors)
                    ids, vectors = [], []
                ids.append(i)
                vectors.append(v)
        if ids:
            yield packed(ids, vectors)
    return run


def _matrix(ids: bytes, vectors: bytes, dim: int) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(ids, np.int64), np.frombuffer(vectors, np.int64).reshape(-1, dim)


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer products of the rows of a with the rows of b."""
    most = int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0)) * a.shape[1]
    if most < 1 << 53:  # every partial sum is a whole number that a double holds
        return (a.astype(float) @ b.astype(float).T).astype(np.int64)
    if most < 1 << 63:
        return a @ b.T
    raise OverflowError("an inner product of these vectors does not fit into 64 bits")


def survivors(query: np.ndarray, bucket: np.ndarray, lengths: np.ndarray, bound: float,
              low_cosine: float = LOW_COSINE, focus: int = FOCUS) -> np.ndarray:
    """Rows of a bucket (in descending order of length) that may have a
    product with ``query`` of at least ``bound``."""
    size = float(np.sqrt((query.astype(float) ** 2).sum()))
    if bound <= 0 or not size:
        return np.arange(len(bucket)) if bound <= 0 else np.arange(0)
    slack = 1e-9 * (1 + abs(bound))
    reach = int(np.searchsorted(-lengths * size, -(bound - slack), side="right"))  # |q| |c| >= bound
    if bound / (size * max(lengths[0], 1e-300)) < low_cosine:
        return np.arange(reach)
    axes = np.argsort(-np.abs(query), kind="stable")[:focus]
    part = bucket[:reach][:, axes].astype(float)
    rest = np.sqrt(np.maximum(lengths[:reach] ** 2 - (part ** 2).sum(axis=1), 0) + 1e-6)
    left = np.sqrt(max(size ** 2 - float((query[axes].astype(float) ** 2).sum()), 0))
    return np.flatnonzero(part @ query[axes].astype(float) + rest * left >= bound - slack)


def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """The k best by score, then by smaller id."""
    if len(ids) > 4 * k:
        floor = np.partition(scores, len(scores) - k)[len(scores) - k]
        keep = np.flatnonzero(scores >= floor)
    else:
        keep = np.arange(len(ids))
    return keep[np.lexsort((ids[keep], -scores[keep]))[:k]]


def top_k(queries: DataFrame, candidates: DataFrame, k: int = 10, bucket_rows: int = BUCKET_ROWS,
          block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id``, ``score``: each query's k
    best candidates by inner product, ties to the smaller ``vec_id``.

    Both sides come from :func:`integer_vectors`.  A query's own rows, those
    with its id, are no candidates of it; a query id that occurs repeatedly
    with the same vector is one query; candidates that occur repeatedly count
    each.  Vectors of different dimensions have no product.  Fewer candidates
    than k give fewer rows; empty sides an empty result.
    """
    spark = queries.sparkSession
    order = candidates.select("vec_id", "v", "dim", "len2").repartitionByRange("dim", F.desc("len2"), "vec_id")
    buckets = materialize(order.sortWithinPartitions("dim", F.desc("len2"), "vec_id")
                          .mapInArrow(_pack(bucket_rows), PACKED), "topk-buckets")
    asked = queries.select("vec_id", "v", "dim", "len2").dropDuplicates(["vec_id", "v"])
    blocks = materialize(asked.repartitionByRange("dim", F.desc("len2"), "vec_id")
                         .sortWithinPartitions("dim", F.desc("len2"), "vec_id")
                         .mapInArrow(_pack(block_rows), PACKED), "topk-blocks")
    # the longest bucket of each dimension: one packed row for each dimension
    longest = buckets.groupBy("dim").agg(F.max_by(F.struct("ids", "vectors"), F.col("top")).alias("b"))
    first = longest.select("dim", F.col("b.ids").alias("c_ids"), F.col("b.vectors").alias("c_vectors"))

    def bounds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                q_ids, q = _matrix(r["ids"], r["vectors"], r["dim"])
                c_ids, c = _matrix(r["c_ids"], r["c_vectors"], r["dim"])
                scores, own = _products(q, c).astype(float), q_ids[:, None] == c_ids[None, :]
                scores[own] = -np.inf
                low = np.full(len(q_ids), -np.inf)
                if len(c_ids) >= k:
                    low = np.partition(scores, len(c_ids) - k, axis=1)[:, len(c_ids) - k]
                sizes = np.sqrt((q.astype(float) ** 2).sum(axis=1))
                needs = float(np.min(np.where(sizes > 0, low / np.maximum(sizes, 1e-300), -np.inf)))
                yield pa.RecordBatch.from_pydict({
                    "dim": pa.array([r["dim"]], pa.int32()), "ids": [r["ids"]], "vectors": [r["vectors"]],
                    "low": [low.tobytes()], "needs": [needs]})

    asked = materialize(blocks.drop("top").join(F.broadcast(first), "dim").repartition(
        max(1, spark.sparkContext.defaultParallelism)).mapInArrow(
        bounds, "dim int, ids binary, vectors binary, low binary, needs double"), "topk-bounds")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                r = {name: batch.column(name)[i].as_py() for name in batch.schema.names}
                yield from one(r)

    def one(r: dict) -> Iterator[pa.RecordBatch]:
        q_ids, q = _matrix(r["ids"], r["vectors"], r["dim"])
        c_ids, c = _matrix(r["c_ids"], r["c_vectors"], r["dim"])
        lengths, low = np.sqrt((c.astype(float) ** 2).sum(axis=1)), np.frombuffer(r["low"], float)
        found = []
        for i in range(len(q_ids)):
            rows = survivors(q[i], c, lengths, low[i])
            rows = rows[c_ids[rows] != q_ids[i]]
            if not len(rows):
                continue
            scores = _products(q[i:i + 1], c[rows])[0]
            rows, scores = rows[scores >= low[i]], scores[scores >= low[i]]
            best = _best(c_ids[rows], scores, k)
            found.append((np.full(len(best), q_ids[i]), c_ids[rows[best]], scores[best]))
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*found)],
                                             names=["query_id", "vec_id", "score"])

    # the stated query set against all rows, block by block: buckets are dealt over lanes, and each
    # lane gets every block; pairs out of reach go before any product is made
    lanes = 4 * spark.sparkContext.defaultParallelism
    sides = buckets.select(F.col("dim").alias("c_dim"), "top", F.col("ids").alias("c_ids"),
                           F.col("vectors").alias("c_vectors"), F.pmod(F.xxhash64("ids"), F.lit(lanes)).alias("lane"))
    asked = asked.withColumn("lane", F.explode(F.sequence(F.lit(0), F.lit(lanes - 1)).cast("array<long>")))
    pairs = sides.join(asked, (sides["lane"] == asked["lane"]) & (F.col("c_dim") == F.col("dim"))
                       & (F.col("top") >= F.col("needs") * (1 - 1e-9)))
    found = pairs.select("dim", "ids", "vectors", "low", "c_ids", "c_vectors").mapInArrow(
        search, "query_id long, vec_id long, score long")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
