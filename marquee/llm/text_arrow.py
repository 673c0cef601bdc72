"""Helpers for work on the bytes of Arrow string columns inside tasks."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All texts of a string column as one byte array, and the n + 1 offsets
    of the texts in it.  Null reads as the empty text."""
    if column.null_count:
        column = pc.fill_null(column, "")
    large = column.cast(pa.large_string()) if not pa.types.is_large_string(column.type) else column
    offsets = np.frombuffer(large.buffers()[1], dtype=np.int64,
                            count=len(large) + 1, offset=8 * large.offset)
    raw = large.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def slices(batches: Iterator[pa.RecordBatch], text: str, max_bytes: int) -> Iterator[pa.RecordBatch]:
    """Batches cut into runs of whole rows with about ``max_bytes`` of text
    each, so that a task's memory does not follow the batch size.  A text
    longer than that is a run of its own.  What Arrow and the C library keep
    of memory that is done with goes back when all batches are read: an idle
    worker holds none."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        start, total = 0, 0
        for i, size in enumerate(sizes.tolist()):
            if total and total + size > max_bytes:
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += size
        yield batch.slice(start)
    release_memory()


def release_memory() -> None:
    """Give freed memory back to the system (the C library's only where it can)."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
#: Last bytes of texts after which a space certainly starts a new match.
_CLOSED = np.zeros(256, bool)
_CLOSED[33:127] = True
_CLOSED[128:] = True


def safe_cuts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Positions at which the texts may be cut before pre-splitting.

    A match of the pre-splitting pattern holds white space only at its start
    or throughout, and its one lookahead looks to the right of white space.
    So no match, and no lookahead, reaches over the border between a character
    that is no white space and a white-space character after it.  Cutting
    there leaves every match as it is.  Only ASCII white space counts as the
    right-hand character.  On the left, characters that might be Unicode
    white space (U+0085, U+00A0, and all of the three-byte ranges that have
    any) are taken as unsafe, which costs a cut and never a result.
    """
    n = len(data)
    if not n:
        return np.unique(offsets)
    cut = np.zeros(n + 1, bool)
    if n > 1:
        left = _CLOSED[data[:-1]]
        high = np.flatnonzero(_SPACE[data[1:]] & (data[:-1] >= 128)) + 1
        cut[1:n] = _SPACE[data[1:]] & left
        if len(high):
            two = (data[np.maximum(high - 2, 0)] == 0xC2) & np.isin(data[high - 1], (0x85, 0xA0))
            three = np.isin(data[np.maximum(high - 3, 0)], (0xE1, 0xE2, 0xE3))
            cut[high[two | three]] = False
    cut[offsets] = True
    return np.flatnonzero(cut)


class PieceEncoder:
    """Encodes texts piece by piece, each different piece of a batch once.

    ``encode`` maps a list of piece texts to a list of id lists.  Pieces come
    from :func:`safe_cuts`, so joining their ids gives the ids of the text.
    The first ``keep`` different pieces, which the frequent ones are among, are
    remembered between batches: one array of their texts and one of their ids.
    """

    def __init__(self, encode, keep: int = 300_000):
        self.encode, self.keep = encode, keep
        self.known = pa.array([], pa.large_string())
        self.ids, self.lengths = np.zeros(0, np.uint32), np.zeros(0, np.int64)

    def __call__(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in one array, and the n + 1 offsets of the texts."""
        data, offsets = text_bytes(column)
        cuts = safe_cuts(data, offsets)
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
        data = np.ascontiguousarray(data)
        pieces = pa.Array.from_buffers(pa.large_string(), len(cuts) - 1,
                                       [None, pa.py_buffer(cuts.astype(np.int64)), pa.py_buffer(data)])
        coded = pieces.dictionary_encode()
        words, n = coded.dictionary, len(self.known)
        at = pc.index_in(words, value_set=self.known)
        new = words.filter(at.is_null())
        row = pc.fill_null(at, -1).to_numpy().astype(np.int64)
        row[row < 0] = np.arange(n, n + len(new))
        flat, lengths = self.ids, self.lengths
        if len(new):
            lists = self.encode(new.to_pylist())
            sizes = np.fromiter(map(len, lists), np.int64, len(lists))
            own = np.fromiter(chain.from_iterable(lists), np.uint32, int(sizes.sum()))
            flat, lengths = np.concatenate((flat, own)), np.concatenate((lengths, sizes))
        first = np.cumsum(lengths) - lengths
        row = row[coded.indices.to_numpy()]
        per_piece = lengths[row]
        ends = np.concatenate(([0], np.cumsum(per_piece)))
        where = np.repeat(first[row] - ends[:-1], per_piece)
        where += np.arange(ends[-1])
        if room := min(self.keep - n, len(new)):
            self.known = pa.concat_arrays([self.known, new.slice(0, room)])
            self.lengths = lengths[:n + room].copy()
            self.ids = flat[:self.lengths.sum()].copy()
        return flat[where], ends[np.searchsorted(cuts, offsets)]
