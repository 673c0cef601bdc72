"""Repeated byte strings by longest-previous-factor arrays.

A byte is part of a repeat if a string of ``length`` bytes that covers it also
starts somewhere else.  In suffix order the earlier matches of a suffix lie at
its previous and next smaller positions (PSV, NSV); the longer of the two
common prefixes is its longest previous factor (LPF).  Suffixes with an LPF of
``length`` or more are later copies; those that a later copy points at are
first ones.

A suffix array of a whole corpus would sort every byte.  Most suffixes cannot
match, and two steps leave those out without losing a match:

1. Every string of ``length`` bytes has an anchor, the window of ``GRAM``
   bytes in it with the smallest hash.  Equal strings have equal anchors at
   equal places.  Starts with the same anchor are neighbours: one row has them
   all, with a hash of the anchor and a hash of the whole stretch of text that
   their strings cover.  Rows whose anchor occurs once cannot match.
2. Stretches that are equal as a whole match in every start.  They are counted
   with partial sums, and the first of them stands for all.

The different stretches around one anchor form a group.  Groups are dealt to
tasks, which sort the suffixes of each, and take common prefixes, smaller
positions and LPFs from that order.  A group of more than ``GROUP_STRETCHES``
(the border of a passage that a third of all documents share) is dealt by
hashes, first of blocks of suffixes and then, where those differ in part, of
single suffixes' first ``length`` bytes: the order of suffixes that differ
within those does not matter for an LPF of ``length``, and among equal ones
the earliest position is found by partial minima.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.jaccard import _BASE, _BASE_INVERSE, _mix, _powers
from marquee.llm.text_arrow import slices, text_bytes
from marquee.operators.joins import join_small_side
from marquee.session import materialize

LENGTH = 200
GRAM = 64
GROUP_STRETCHES = 256
BLOCK = 16
SLICE_BYTES = 1 << 20
BUFFER_BYTES = 1 << 20
_POSITION = np.uint64((1 << 31) - 1)
_BYTE = np.random.default_rng(977).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


class Hashes:
    """Hashes of any stretch of a byte array in constant time."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def load(self, data: np.ndarray) -> None:
        n = len(data)
        if n >= len(self.up):
            self.up, self.down = _powers(_BASE, n + 1), _powers(_BASE_INVERSE, n + 1)
        self.total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_BYTE[data] * self.up[:n], dtype=np.uint64)))

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return _mix((self.total[end] - self.total[start]) * self.down[start])


def anchors(hashes: Hashes, data: np.ndarray, offsets: np.ndarray, length: int, gram: int):
    """Rows (first start, last start, anchor's hash, stretch's hash) of all
    texts in a byte array, in order."""
    n = len(data)
    none = np.zeros(0, np.int64)
    if n < length:
        return none, none, none.astype(np.uint64), none.astype(np.uint64)
    hashes.load(data)
    grams = _mix((hashes.total[gram:] - hashes.total[:-gram]) * hashes.down[:n - gram + 1])
    least = (grams & ~_POSITION) | np.arange(len(grams), dtype=np.uint64)  # the leftmost of equal ones
    width, have = length - gram + 1, 1
    while have * 2 <= width:
        least = np.minimum(least[:-have], least[have:])
        have *= 2
    if have < width:
        least = np.minimum(least[:len(least) - (width - have)], least[width - have:])
    at = (least & _POSITION).astype(np.int64)
    own = np.diff(offsets)
    inside = np.repeat(offsets[1:], own)[:len(at)] - np.arange(len(at)) >= length
    turn = np.flatnonzero(at[1:] != at[:-1]) + 1
    change = np.zeros(len(at) + 1, bool)
    change[turn] = True
    change[0] = change[-1] = True
    gap = np.concatenate(([False], inside[1:] != inside[:-1], [False]))
    change |= gap
    edges = np.flatnonzero(change)
    lo, hi = edges[:-1], edges[1:] - 1
    keep = inside[lo]
    lo, hi = lo[keep], hi[keep]
    a = at[lo]
    place = ((a - lo) << 32 | (hi - lo)).astype(np.uint64)
    return lo, hi, grams[a], _mix(hashes.of(lo, hi + length) ^ _mix(place))


def suffix_ranks(data: np.ndarray, length: int) -> list[tuple[int, np.ndarray]]:
    """Ranks of all suffixes by their first 8, 16, ... bytes up to ``length``
    (at least 8), by prefix doubling from 8-byte words.  Suffixes that begin
    less than that before the end have no rank."""
    words = np.lib.stride_tricks.sliding_window_view(data, 8)
    rank = np.unique(np.ascontiguousarray(words).view(">u8").reshape(-1), return_inverse=True)[1]
    out, have = [(8, rank)], 8
    while have < length:
        step = min(have, length - have)
        pair = rank[:-step].astype(np.uint64) << np.uint64(32) | rank[step:].astype(np.uint64)
        rank = np.unique(pair, return_inverse=True)[1]
        have += step
        out.append((have, rank))
    return out


def previous_factors(ranks: list[tuple[int, np.ndarray]], starts: np.ndarray, position: np.ndarray,
                     length: int, floor: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """LPFs, up to ``length``, and the earlier matches they come from, for the
    suffixes at ``starts``; ``position`` is their order in the corpus.

    Suffixes are sorted by their first ``length`` bytes, then by position.
    Common prefixes of neighbours come from the ranks, from long to short.
    The previous and next smaller positions of all suffixes are found by
    jumping: each pointer moves on along the pointers already there.  LPFs
    below ``floor`` may come out as 0; those below ``length`` are rounded down
    to a multiple of 8.
    """
    order = np.lexsort((position, ranks[-1][1][starts]))
    own, pos, m = starts[order], position[order], len(starts)
    common = np.zeros(m, np.int64)  # of each suffix with the one before it in order
    for have, rank in reversed(ranks):
        x, y = own[:-1] + common[1:], own[1:] + common[1:]
        fits = (common[1:] + have <= length) & (x < len(rank)) & (y < len(rank))
        x, y = np.where(fits, x, 0), np.where(fits, y, 0)
        common[1:] += np.where(fits & (rank[x] == rank[y]), have, 0)

    def smaller(step: int) -> tuple[np.ndarray, np.ndarray]:
        """Index of the nearest smaller position on one side (-1: none), and
        the common prefix with it."""
        to = np.arange(m) + step
        prefix = common.copy() if step < 0 else np.concatenate((common[1:], [0]))
        out = (to < 0) | (to >= m)
        to[out], prefix[out] = -1, 0
        while True:
            wrong = np.flatnonzero((to >= 0) & (pos[to] >= pos) & (prefix >= floor))
            if not len(wrong):
                break
            via = to[wrong]
            prefix[wrong] = np.where(to[via] >= 0, np.minimum(prefix[wrong], prefix[via]), 0)
            to[wrong] = to[via]
        low = (to < 0) | (prefix < floor)
        to[low], prefix[low] = -1, 0
        return to, prefix

    before, with_before = smaller(-1)
    after, with_after = smaller(1)
    lpf, source = np.zeros(m, np.int64), np.full(m, -1)
    left = with_before >= with_after
    lpf[order] = np.where(left, with_before, with_after)
    chosen = np.where(left, before, after)
    source[order] = np.where(chosen >= 0, order[np.maximum(chosen, 0)], -1)
    return lpf, source


def _repeated(lpf: np.ndarray, source: np.ndarray, length: int, keep: str) -> np.ndarray:
    later = lpf >= length
    if keep == "first":
        return later
    later[source[later]] = True
    return later


def find_repeats(docs: DataFrame, length: int = LENGTH, keep: str = "none", gram: int = GRAM,
                 group_stretches: int = GROUP_STRETCHES) -> DataFrame:
    """``doc_id``, ``content`` (a hash of the text), ``spans``: packed int32
    pairs (start, end) of the maximal repeated runs of bytes, for texts that
    have any.  ``docs`` needs ``doc_id``, ``text``, ``content``.

    ``keep`` is "none" (every copy is told) or "first" (all but the earliest,
    by ``doc_id``, ``content`` and place).
    """
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = Hashes()
        for batch in slices(batches, "text", SLICE_BYTES):
            data, offsets = text_bytes(batch.column("text"))
            lo, hi, anchor, stretch = anchors(hashes, data, offsets, length, gram)
            to = np.searchsorted(lo, offsets)
            text = np.repeat(np.arange(batch.num_rows), np.diff(to))
            lists = [pa.ListArray.from_arrays(pa.array(to.astype(np.int32)), pa.array(x)) for x in (
                (lo - offsets[text]).astype(np.int32), (hi - offsets[text]).astype(np.int32),
                anchor.view(np.int64), stretch.view(np.int64))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("content"), *lists],
                                             names=["doc_id", "content", "lo", "hi", "anchor", "stretch"])

    found = materialize(docs.select("doc_id", "content", "text").mapInArrow(
        scan, "doc_id long, content long, lo array<int>, hi array<int>, anchor array<long>, stretch array<long>"),
        "repeats-anchors")
    rows = found.select("doc_id", "content", F.explode(F.arrays_zip("lo", "hi", "anchor", "stretch")).alias("x")) \
        .select("doc_id", "content", "x.*")
    often = materialize(
        rows.groupBy("anchor").agg(F.count("*").alias("n"), F.min("stretch").alias("a"), F.max("stretch").alias("b"))
        .filter("n > 1").select("anchor", (F.col("a") == F.col("b")).alias("alike")), "repeats-often")
    rows = materialize(rows.join(often, "anchor"), "repeats-rows")
    # one row for each different stretch: how many, and the first
    place = F.struct("doc_id", "content", "lo", "hi")
    stretches = materialize(rows.groupBy("anchor", "stretch", "alike").agg(
        F.count("*").alias("n"), F.min(place).alias("first")), "repeats-stretches")
    whole = rows.join(stretches.filter("n > 1").select("anchor", "stretch", "first"), ["anchor", "stretch"])
    if keep == "first":
        whole = whole.filter(F.struct("doc_id", "content", "lo", "hi") != F.col("first"))
    whole = whole.select("doc_id", "content", "lo", "hi")

    mixed = stretches.filter(~F.col("alike"))
    sizes = mixed.groupBy("anchor").agg((F.count("*") > group_stretches).alias("large"))
    mixed = mixed.join(sizes, "anchor").select("anchor", "n", "large", "first.*")
    asked = materialize(mixed.groupBy("doc_id", "content").agg(
        F.collect_list(F.struct("anchor", "n", "large", "lo", "hi")).alias("asked")), "repeats-asked")
    texts = join_small_side(docs.select("doc_id", "content", "text"), asked, ["doc_id", "content"])
    parts = materialize(texts.mapInArrow(
        _cut(length), "doc_id long, content long, anchor long, n long, large boolean, lo int, bytes binary"),
        "repeats-parts")

    def sort_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("anchor", "doc_id", "content", "lo", "n", "bytes"))):
                if held and row[:4] == held[-1][:4]:
                    continue  # the same text of a repeated row
                if size >= BUFFER_BYTES and row[0] != held[-1][0]:
                    yield from one(held)
                    held, size = [], 0
                held.append(row)
                size += len(row[5])
        if held:
            yield from one(held)

    def one(held: list[tuple]) -> Iterator[pa.RecordBatch]:
        """Some whole groups, in corpus order within each."""
        data = np.frombuffer(b"".join(r[5] for r in held) + b"\0" * 8, np.uint8)
        begin = np.concatenate(([0], np.cumsum([len(r[5]) for r in held])))
        count = np.array([len(r[5]) - length + 1 for r in held])
        part = np.repeat(np.arange(len(held)), count)
        shift = np.arange(len(part)) - np.repeat(np.cumsum(count) - count, count)
        # a row stands for n places: a later row of the group, or another of the n, is another place
        lpf, source = previous_factors(suffix_ranks(data, length), begin[:-1][part] + shift,
                                       np.arange(len(part)), length, floor=length)
        told = _repeated(lpf, source, length, keep)
        if keep == "none":
            told |= np.array([r[4] > 1 for r in held])[part]
        runs = np.flatnonzero(np.diff(np.concatenate(([0], told.view(np.int8), [0])) + 0)
                              | np.concatenate(([True], part[1:] != part[:-1], [True])))
        lo, hi = runs[:-1], runs[1:] - 1
        lo, hi = lo[told[lo]], hi[told[lo]]
        if len(lo):
            base = np.array([r[3] for r in held])
            yield pa.RecordBatch.from_arrays(
                [pa.array([held[p][1] for p in part[lo]], pa.int64()),
                 pa.array([held[p][2] for p in part[lo]], pa.int64()),
                 pa.array((base[part[lo]] + shift[lo]).astype(np.int32)),
                 pa.array((base[part[lo]] + shift[hi]).astype(np.int32))], names=["doc_id", "content", "lo", "hi"])

    small = (parts.filter(~F.col("large")).repartition("anchor").sortWithinPartitions("anchor", "doc_id", "content", "lo"))
    small = small.select("anchor", "doc_id", "content", "lo", "n", "bytes").mapInArrow(
        sort_groups, "doc_id long, content long, lo int, hi int")

    # large groups: blocks of starts by their place to the anchor.  Strings of one block share a
    # core; equal blocks stand for each other, and only blocks that share a core with different
    # ones are taken apart into single starts.
    blocks = materialize(parts.filter("large").dropDuplicates(["anchor", "doc_id", "content", "lo"]).select(
        "anchor", "doc_id", "content", "lo", "n", "bytes").mapInArrow(
        _blocks(length, gram), "doc_id long, content long, lo int, hi int, n long, core long, whole_1 long, "
        "whole_2 long, name_1 array<long>, name_2 array<long>"), "repeats-blocks")
    cores = materialize(blocks.groupBy("core").agg(
        F.sum("n").alias("n"), (F.min("whole_1") == F.max("whole_1")).alias("alike")).filter("n > 1").drop("n"), "repeats-cores")
    blocks = materialize(blocks.join(cores, "core"), "repeats-cored")
    equal_blocks = materialize(blocks.groupBy("core", "whole_1", "whole_2", "alike").agg(
        F.sum("n").alias("n"), F.min(F.struct("doc_id", "content", "lo", "hi", "name_1", "name_2")).alias("first")),
        "repeats-equal")
    large = blocks.join(equal_blocks.filter("n > 1").select(
        "core", "whole_1", "whole_2", F.struct("first.doc_id", "first.content", "first.lo").alias("first")),
        ["core", "whole_1", "whole_2"])
    own = F.struct("doc_id", "content", "lo")
    if keep == "first":
        large = large.filter(own != F.col("first"))
    large = large.select("doc_id", "content", "lo", "hi")
    starts = materialize(equal_blocks.filter("not alike").select(
        "n", "first.*").select("n", "doc_id", "content", F.col("lo").alias("base"), F.posexplode(F.arrays_zip("name_1", "name_2")))
        .select("n", "doc_id", "content", (F.col("base") + F.col("pos")).alias("lo"), "col.*"), "repeats-starts")
    equal = materialize(starts.groupBy("name_1", "name_2").agg(F.sum("n").alias("total"), F.min(own).alias("first"))
                        .filter("total > 1"), "repeats-names")
    single = starts.join(equal, ["name_1", "name_2"])
    if keep == "first":
        single = single.filter(own != F.col("first"))
    large = large.unionByName(single.select("doc_id", "content", "lo", F.col("lo").alias("hi")))

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = []
            for r in batch.column("ranges").to_numpy(zero_copy_only=False):
                lo, hi = (r >> 32).astype(np.int64), (r & 0xFFFFFFFF).astype(np.int64) + length
                order = np.argsort(lo, kind="stable")
                lo, reach = lo[order], np.maximum.accumulate(hi[order])
                new = np.concatenate(([True], lo[1:] > reach[:-1]))
                last = np.concatenate((new[1:], [True]))
                spans.append(np.column_stack((lo[new], reach[last])).astype("<i4").tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("content"), pa.array(spans, pa.binary())],
                                             names=["doc_id", "content", "spans"])

    told = whole.unionByName(small).unionByName(large)
    ranges = told.groupBy("doc_id", "content").agg(F.collect_set(
        F.shiftleft(F.col("lo").cast("long"), 32) + F.col("hi")).alias("ranges"))
    return materialize(ranges.mapInArrow(merge, "doc_id long, content long, spans binary"), "repeats-spans")


def _cut(length: int):
    """The stretches that are asked for of each text, as bytes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SLICE_BYTES):
            data, offsets = text_bytes(batch.column("text"))
            data, asked = data.tobytes(), batch.column("asked")
            text = np.repeat(np.arange(batch.num_rows), np.diff(asked.offsets.to_numpy()))
            flat = asked.flatten()
            lo, hi = (flat.field(c).to_numpy().astype(np.int64) + offsets[text] for c in ("lo", "hi"))
            stretches = pa.array([data[i:j] for i, j in zip(lo.tolist(), (hi + length).tolist())], pa.binary())
            take = pa.array(text)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(take), batch.column("content").take(take),
                 *(flat.field(c) for c in ("anchor", "n", "large", "lo")), stretches],
                names=["doc_id", "content", "anchor", "n", "large", "lo", "bytes"])
    return run


def _blocks(length: int, gram: int):
    """Blocks of up to ``BLOCK`` starts around their anchor, with hashes of
    the bytes that all strings of a whole block share, of all bytes that the
    starts at hand cover, and two of each start's string."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = Hashes()
        for batch in slices(batches, "bytes", SLICE_BYTES // 8):
            stretches = batch.column("bytes").to_pylist()
            size = np.array([len(x) for x in stretches])
            begin = np.cumsum(size) - size
            hashes.load(np.frombuffer(b"".join(stretches), np.uint8))
            total = int(size.sum())
            grams = hashes.of(np.arange(total - gram + 1), np.arange(gram, total + 1))
            row = np.repeat(np.arange(len(size)), size)[:len(grams)]
            hit = np.flatnonzero(grams == batch.column("anchor").to_numpy().view(np.uint64)[row])
            at = hit[np.searchsorted(hit, begin)]  # the anchor is the first such gram of its stretch
            last = begin + size - length  # of the starts
            far, near = (at - begin) // BLOCK, (at - last) // BLOCK
            count = far - near + 1
            part = np.repeat(np.arange(len(size)), count)
            k = near[part] + np.arange(len(part)) - np.repeat(np.cumsum(count) - count, count)
            lo = np.maximum(begin[part], at[part] - k * BLOCK - BLOCK + 1)
            hi = np.minimum(last[part], at[part] - k * BLOCK)
            middle = at[part] - k * BLOCK
            core = _mix(hashes.of(middle, middle + length - BLOCK + 1) ^ _mix(k.astype(np.uint64)))
            where = _mix(((middle - lo) << 32 | (middle - hi)).astype(np.uint64))
            whole = [_mix(h ^ where) for h in _two(hashes, lo, hi + length)]
            steps = hi - lo + 1
            each = np.repeat(np.arange(len(part)), steps)
            start = lo[each] + np.arange(len(each)) - np.repeat(np.cumsum(steps) - steps, steps)
            to = pa.array(np.concatenate(([0], np.cumsum(steps))).astype(np.int32))
            names = [pa.ListArray.from_arrays(to, pa.array(h.view(np.int64))) for h in _two(hashes, start, start + length)]
            take, base = pa.array(part), batch.column("lo").to_numpy()[part] - begin[part]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(take), batch.column("content").take(take),
                 pa.array((base + lo).astype(np.int32)), pa.array((base + hi).astype(np.int32)), batch.column("n").take(take),
                 pa.array(core.view(np.int64)), *(pa.array(h.view(np.int64)) for h in whole), *names],
                names=["doc_id", "content", "lo", "hi", "n", "core", "whole_1", "whole_2", "name_1", "name_2"])
    return run


def _two(hashes: Hashes, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of stretches, of which the second tells their halves apart."""
    middle = (start + end) // 2
    return hashes.of(start, end), _mix(hashes.of(start, middle) ^ _mix(hashes.of(middle, end) + np.uint64(1)))


def remove_repeats(docs: DataFrame, length: int = LENGTH, keep: str = "none", id_col: str = "doc_id",
                   text_col: str = "text", with_bytes: bool = False) -> DataFrame:
    """Each text without its repeated bytes: ``doc_id``, ``n_bytes``,
    ``n_removed``, ``n_spans`` (maximal removed runs), ``kept_sha256`` and, if
    asked, ``kept`` (the bytes that remain).

    Texts are UTF-8 bytes, null is empty, and matches never cross texts.
    Repeats are judged on the input.  With ``keep="first"`` the earliest copy
    of a string stays; rows equal in id and text are then one and the same
    place.  Null ids come before others; repeated ids with different texts
    are different documents; an empty table gives an empty result.  Other
    columns are not read.  A long text is looked at as a whole: a task holds
    one slice of texts, or one text if that is longer.
    """
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                      F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    own = own.withColumn("content", F.xxhash64("text"))
    spans = find_repeats(own.withColumn("doc_id", F.coalesce("doc_id", F.lit(-(1 << 63)).cast("long"))), length, keep)
    keyed = own.withColumn("key", F.coalesce("doc_id", F.lit(-(1 << 63)).cast("long")))
    joined = join_small_side(keyed, spans.withColumnRenamed("doc_id", "key"), ["key", "content"], "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SLICE_BYTES):
            data, offsets = text_bytes(batch.column("text"))
            data = data.tobytes()
            rows = {"doc_id": batch.column("doc_id"), "n_bytes": [], "n_removed": [], "n_spans": [], "kept_sha256": []}
            kept_bytes = []
            for i, packed in enumerate(batch.column("spans").to_pylist()):
                text = data[offsets[i]:offsets[i + 1]]
                own = np.frombuffer(packed or b"", "<i4").reshape(-1, 2)
                kept, at = [], 0
                for start, end in own.tolist():
                    kept.append(text[at:start])
                    at = end
                kept.append(text[at:])
                left = b"".join(kept)
                rows["n_bytes"].append(len(text))
                rows["n_removed"].append(len(text) - len(left))
                rows["n_spans"].append(len(own))
                rows["kept_sha256"].append(hashlib.sha256(left).hexdigest())
                kept_bytes.append(left)
            if with_bytes:
                rows["kept"] = pa.array(kept_bytes, pa.binary())
            yield pa.RecordBatch.from_pydict(rows)

    out = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + (", kept binary" if with_bytes else "")
    return joined.select("doc_id", "text", "spans").mapInArrow(run, out)
