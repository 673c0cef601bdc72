"""Packing of documents into training sequences along a Hilbert curve.

A document's vector has the counts of its token ids by hash, square roots
taken and scaled to length one.  A fixed matrix of orthonormal columns
projects it to a few dimensions, and the place of that point on a Hilbert
curve is the document's key.  Documents are range-sorted by key, so that
neighbours on the curve, which are near each other in the projection and so
have words in common, come into one sequence or the next.

Along that order the ids of all documents are one long row that is cut into
sequences of ``length`` ids.  Places come from the totals of the ranges, so no
task packs more than its own rows, and no range leaves a sequence open: only
the end of the whole row is less than a sequence, and it is cut into powers of
two, which need no padding.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marquee.llm.text_arrow import slices
from marquee.llm.token_files import piece_encoder
from marquee.operators.joins import join_small_side
from marquee.session import materialize

TOKENIZER = "word_bpe_49k.json"
LENGTH = 4096
END_ID = 2
SLICE_BYTES = 4 << 20
#: Hashed vectors' dimensions, those of the projection, bits of each, and rows handled at once.
VECTOR, DIMENSIONS, BITS, ROWS = 256, 4, 15, 1024


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path(TOKENIZER)


def _projection() -> np.ndarray:
    columns, _ = np.linalg.qr(np.random.default_rng(20240613).standard_normal((VECTOR, DIMENSIONS)))
    return columns


def hilbert_keys(points: np.ndarray, bits: int) -> np.ndarray:
    """Places on the Hilbert curve of points with ``bits``-bit coordinates
    (one row each), by the transposed form of Skilling's method: undo the
    rotations from the highest bit down, Gray-code, interleave."""
    x = points.astype(np.int64).T.copy()
    for b in range(bits - 1, 0, -1):
        low = (1 << b) - 1
        for axis in x:
            set_ = (axis >> b) & 1 == 1
            swap = np.where(set_, 0, (x[0] ^ axis) & low)
            x[0] ^= np.where(set_, low, swap)
            axis ^= swap
    for i in range(1, len(x)):
        x[i] ^= x[i - 1]
    turn = np.zeros(x.shape[1], np.int64)
    for b in range(bits - 1, 0, -1):
        turn ^= np.where((x[-1] >> b) & 1 == 1, (1 << b) - 1, 0)
    x ^= turn
    keys = np.zeros(x.shape[1], np.int64)
    for b in range(bits - 1, -1, -1):
        for axis in x:
            keys = keys << 1 | ((axis >> b) & 1)
    return keys


def curve_keys(ids: np.ndarray, ends: np.ndarray, projection: np.ndarray) -> np.ndarray:
    """Curve keys of documents with the ids ``ids[ends[i]:ends[i + 1]]``."""
    out = []
    for i in range(0, len(ends) - 1, ROWS):
        to = ends[i:i + ROWS + 1]
        n = len(to) - 1
        own = ids[to[0]:to[-1]].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        column = (own >> np.uint64(56)).astype(np.int64) % VECTOR
        row = np.repeat(np.arange(n), np.diff(to))
        vector = np.sqrt(np.bincount(row * VECTOR + column, minlength=n * VECTOR).reshape(n, VECTOR))
        vector /= np.maximum(np.linalg.norm(vector, axis=1, keepdims=True), 1)  # no ids: the origin
        points = np.round((vector @ projection + 1) / 2 * ((1 << BITS) - 1))
        out.append(hilbert_keys(np.clip(points, 0, (1 << BITS) - 1), BITS))
    return np.concatenate(out)


def encoded_documents(docs: DataFrame, tokenizer_path: str, end_id: int, id_col: str, text_col: str,
                      width: str) -> DataFrame:
    """``doc_id``, ``key``, ``row`` (tells repeated rows apart), ``n``,
    ``ids`` as packed integers of the NumPy type ``width``, the end id
    included, and their ``hash``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, projection = piece_encoder(tokenizer_path), _projection()
        tail = np.array([end_id], width).tobytes()
        row = TaskContext.get().partitionId() << 40
        for batch in slices(batches, "text", SLICE_BYTES):
            ids, ends = encode(batch.column("text"))
            data = ids.astype(width).tobytes()
            at = (np.dtype(width).itemsize * ends).tolist()
            packed = [data[a:b] + tail for a, b in zip(at[:-1], at[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(curve_keys(ids, ends, projection)),
                 pa.array(np.arange(row, row + batch.num_rows)), pa.array(np.diff(ends) + 1),
                 pa.array(packed, pa.binary()), pa.array(map(zlib.crc32, packed), pa.int64())],
                names=["doc_id", "key", "row", "n", "ids", "hash"])
            row += batch.num_rows

    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return own.mapInArrow(run, "doc_id long, key long, row long, n long, ids binary, hash long")


def id_width(tokenizer_path: str, end_id: int) -> str:
    """The narrowest type that holds every id."""
    from tokenizers import Tokenizer
    return "<u2" if max(Tokenizer.from_file(tokenizer_path).get_vocab_size() - 1, end_id) < 1 << 16 else "<u4"


def sequence_bounds(total: int, length: int) -> list[int]:
    """Where the sequences after the full ones begin, and the end: steps are
    different powers of two, the largest first."""
    bounds = [total // length * length]
    for b in range(length.bit_length() - 2, -1, -1):
        if total % length >> b & 1:
            bounds.append(bounds[-1] + (1 << b))
    return bounds


def pack_documents(docs: DataFrame, tokenizer_path: str | None = None, length: int = LENGTH,
                   end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of documents in sequences of ``length`` ids, one row each:
    ``doc_id``, ``start`` (ids of its document before it), ``length``, ``ids``
    (little-endian unsigned 32-bit integers), ``doc_tokens``, ``sequence_id``
    and ``offset`` in the sequence.

    Texts are encoded as the tokenizer's plain call without added special
    tokens does, and ``end_id`` is appended.  Sequences are full, but for at
    most ``log2(length)`` at the end, whose sizes are different powers of two.
    Documents on one place of the curve, copies among them, are ordered by id
    (null first), then by a hash of their ids.

    Null and empty texts have the end id alone; repeated rows and ids are
    documents of their own; a long text is cut like any other, its ids held
    by one task at a time; an empty table gives an empty result; other columns
    are not read.  The ids are written once as encoded and once in order
    (tables in the checkpoint folder): the first for sampling the ranges, the
    second for reading totals before places.
    """
    if length < 1 or length & (length - 1):
        raise ValueError("the length of a sequence must be a power of two")
    tokenizer_path = tokenizer_path or default_tokenizer()
    width = id_width(tokenizer_path, end_id)
    encoded = materialize(encoded_documents(docs, tokenizer_path, end_id, id_col, text_col, width), "packing-encoded")
    order = ["key", "doc_id", "hash", "row"]  # splits a large group of copies between ranges

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, total = TaskContext.get().partitionId(), 0
        for batch in batches:
            n = batch.column("n").to_numpy()
            before = total + np.cumsum(n) - n
            total += int(n.sum())
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(n), shard, np.int32)), pa.array(before), *batch.columns],
                                             names=["shard", "before", "row", "n"])

    ordered = encoded.select(*order, "n").repartitionByRange(*order).sortWithinPartitions(*order).select("row", "n")
    ordered = materialize(ordered.mapInArrow(place, "shard int, before long, row long, n long"), "packing-order")
    shards = materialize(ordered.groupBy("shard").agg(F.sum("n").alias("own")), "packing-shards")
    total = shards.agg(F.sum("own")).first()[0] or 0
    starts = shards.select("shard", (F.sum("own").over(Window.orderBy("shard")) - F.col("own")).alias("shard_start"))
    places = materialize(ordered.join(F.broadcast(starts), "shard")  # a row for each shuffle partition
                         .select("row", (F.col("shard_start") + F.col("before")).alias("at")), "packing-places")
    placed = join_small_side(encoded.select("doc_id", "row", "ids"), places, "row")

    bounds = sequence_bounds(total, length)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, held = [], 0
            for doc_id, start, raw in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "at", "ids"))):
                ids = np.frombuffer(raw, width).astype("<u4").tobytes()
                n, x = len(ids) // 4, start
                while x < start + n:
                    if x < bounds[0]:
                        sequence, begin, end = x // length, x // length * length, (x // length + 1) * length
                    else:
                        k = bisect_right(bounds, x) - 1
                        sequence, begin, end = bounds[0] // length + k, bounds[k], bounds[k + 1]
                    end = min(end, start + n)
                    rows.append((doc_id, x - start, end - x, ids[4 * (x - start):4 * (end - start)], n, sequence, x - begin))
                    held, x = held + end - x, end
                    if held >= ROWS * length:
                        yield _piece_rows(rows)
                        rows, held = [], 0
            if rows:
                yield _piece_rows(rows)

    return placed.select("doc_id", "at", "ids").mapInArrow(cut, _PIECES)


_PIECES = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


def _piece_rows(rows: list[tuple]) -> pa.RecordBatch:
    names = [c.split()[0] for c in _PIECES.split(", ")]
    return pa.RecordBatch.from_arrays(
        [pa.array(list(c), pa.binary() if name == "ids" else pa.int64()) for c, name in zip(zip(*rows), names)], names=names)


def sequences(pieces: DataFrame, length: int = LENGTH, pad_id: int = END_ID) -> DataFrame:
    """One row for each sequence of :func:`pack_documents`: ``sequence_id``,
    ``n_tokens``, ``ids`` (an array, padded to ``length`` unless ``n_tokens``
    is a power of two) and ``starts`` (where documents' pieces begin in it).
    No group holds more than ``length`` pieces."""
    own = pieces.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "length", "ids"))).alias("p"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for p in batch.column("p").to_pylist():
                ids = np.frombuffer(b"".join(x["ids"] for x in p), "<u4").astype(np.int32)
                n = len(ids)
                padding = 0 if n & (n - 1) == 0 else length - n
                rows.append((n, np.concatenate((ids, np.full(padding, pad_id, np.int32))), [x["offset"] for x in p]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("sequence_id"), pa.array([r[0] for r in rows], pa.int64()),
                 pa.array([r[1] for r in rows], pa.list_(pa.int32())), pa.array([r[2] for r in rows], pa.list_(pa.int64()))],
                names=["sequence_id", "n_tokens", "ids", "starts"])

    return own.mapInArrow(run, "sequence_id long, n_tokens long, ids array<int>, starts array<long>")
