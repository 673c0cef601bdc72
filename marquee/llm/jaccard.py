"""Exact Jaccard links between word-shingle sets, and their components.

Tokens are 64-bit hashes of five-word shingles.  Their global order puts the
frequent class last (tokens in more than a small share of all documents, found
in one pass), and is by hash otherwise.  Two sets that reach the threshold
share a token within their prefixes, and k tokens within prefixes that are
k - 1 tokens longer (k = 2 here: extended prefixes).

Documents with equal sets share one set id throughout, so copies are never
expanded.  Candidates are not expanded into all pairs either:

* A set is looked at only while it can link.  For each class of sizes, the
  tokens that it has in groups with sets of that class and another component
  must be as many as a pair of such sizes has to share.  Sets that fall short
  leave their groups, which may leave others short.
* Near copies are joined by stars: sets with one least-hashed token have one
  centre, by several hashes, and each set tries the centre that most of them
  agree on (as many pairs as sets at most).  Centres are chosen for each class
  of sizes: the sets with the fewest tokens of their own, which the others are
  copies of if any.
* What is left are sets that can link with another component.  A token's
  group is led by its member of the least hash, and all groups of one leader
  make one block: two sets with a token in common are both in its leader's
  block.  The sets of a block are compared in a task, by their sketches, so a
  family of many sets costs rows of its sets, not of its pairs.  Large blocks
  are cut by sizes and into parts of which each two meet in a task.  A set is
  in the blocks of the first of its open tokens only, those of small groups
  first, as many as leave fewer behind them than a pair must share.

Each set has a sketch: the parities of its tokens by some bits of their hash.
Two sketches differ in no more places than the sets differ in tokens, so pairs
whose sketches differ in too many cannot link.  Every link is verified on whole
sets, which go to the tasks once for each block; pairs of one component that
others have joined are left out.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marquee.llm.graph import connected_components
from marquee.llm.text_arrow import slices, text_bytes
from marquee.operators.joins import join_small_side
from marquee.session import discard, materialize

SLICE_BYTES = 1 << 18
#: Share of documents from which a token counts as frequent in the order, and
#: the number of documents after which a task counts anew.
FREQUENT_SHARE, FREQUENT_CHUNK = 0.0005, 8192
#: Tokens that a task holds at most before it counts, besides one document's.
CHUNK_TOKENS = 1 << 21
#: Sets in a block from which it is dealt to several tasks.
LARGE_GROUP = 4096
#: Bytes of whole sets in a block from which it is dealt to several tasks.
BLOCK_BYTES = 1 << 24
#: Bytes of sketches compared at a time, and pairs that a task holds.
COMPARED_BYTES, PAIRS_HELD = 1 << 22, 1 << 16
#: Rounds of stars, and hashes in each.
STAR_ROUNDS, STARS = 1, 16
#: Rounds in which sets that cannot link leave their groups, and classes of sizes in one factor of the threshold.
PRUNE_ROUNDS, SIZE_CLASSES = 1, 12
#: Bits of a sketch: the power of two from a set's size on, within these.
SKETCH_BITS = 256, 1 << 14

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_random = np.random.default_rng(20240517)
_BYTE = _random.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BYTE[65:91] = _BYTE[97:123]  # A-Z as a-z
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_BASE_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


class Shingler:
    """Distinct shingle hashes of texts."""

    def __init__(self, words: int = 5):
        self.words = words
        self.up = self.down = np.ones(1, np.uint64)
        self.steps = _mix(np.arange(1, words + 1, dtype=np.uint64)) | np.uint64(1)

    def __call__(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Shingles of all texts (not yet distinct) and the offsets of the texts."""
        data, offsets = text_bytes(column)
        n, k = len(data), self.words
        if not n:
            return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
        if n >= len(self.up):
            self.up, self.down = _powers(_BASE, n + 1), _powers(_BASE_INVERSE, n + 1)
        inside = ~_SPACE[data]
        edge = np.zeros(n + 1, bool)  # a text ends here and the next begins
        edge[offsets] = True
        starts = np.flatnonzero(inside & (np.concatenate(([True], ~inside[:-1])) | edge[:-1]))
        ends = np.flatnonzero(inside & (np.concatenate((~inside[1:], [True])) | edge[1:])) + 1
        total = np.concatenate(([np.uint64(0)], np.cumsum(_BYTE[data] * self.up[:n], dtype=np.uint64)))
        own = _mix((total[ends] - total[starts]) * self.down[starts] + (ends - starts).astype(np.uint64))
        first = np.searchsorted(starts, offsets)  # of each text's words
        count = np.diff(first)
        made = np.where(count >= k, count - k + 1, np.minimum(count, 1))
        to = np.concatenate(([0], np.cumsum(made)))
        text = np.repeat(np.arange(len(count)), made)
        at = first[:-1][text] + np.arange(to[-1]) - to[:-1][text]
        value = np.zeros(to[-1], np.uint64)
        short = count[text]
        own = np.concatenate((own, np.zeros(k, np.uint64)))
        for j in range(k):
            value += np.where(j < short, own[at + j], np.uint64(0)) * self.steps[j]
        return _mix(value + np.minimum(short, k).astype(np.uint64)), to


def _tokens(shingles: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    """63-bit tokens, with the top bit set for the frequent class, so that
    unsigned order is the global order."""
    own = shingles >> np.uint64(1)
    if len(frequent):
        place = np.minimum(np.searchsorted(frequent, own), len(frequent) - 1)
        own = own | ((frequent[place] == own).astype(np.uint64) << np.uint64(63))
    return own


def set_id(tokens: np.ndarray) -> int:
    """The id of a set, from its distinct shingles; 0 is the empty set."""
    own = _mix((tokens & np.uint64((1 << 63) - 1)) ^ np.uint64(0x5851F42D4C957F2D))
    return int(_mix(own.sum(dtype=np.uint64, keepdims=True) + np.uint64(len(own))).view(np.int64)[0]) if len(own) else 0


def sketch(tokens: np.ndarray) -> bytes:
    """The parity of the tokens at each of some places, which their low bits
    tell.  Places that two sketches differ in hold a token of one set only."""
    bits = min(max(1 << max(len(tokens) - 1, 0).bit_length(), SKETCH_BITS[0]), SKETCH_BITS[1])
    places = (tokens & np.uint64(bits - 1)).astype(np.int64)
    return np.packbits(np.bincount(places, minlength=bits) & 1, bitorder="little").tobytes()


def distinct(values: np.ndarray, to: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values of each row, in order, and the offsets of the rows.
    Sorts the values in their place."""
    for i in range(len(to) - 1):
        values[to[i]:to[i + 1]].sort()
    keep = np.ones(len(values), bool)
    keep[1:] = values[1:] != values[:-1]
    keep[to[:-1][to[:-1] < len(values)]] = True  # a row begins
    return values[keep], np.concatenate(([0], np.cumsum(keep)))[to]


def set_ids(tokens: np.ndarray, to: np.ndarray) -> np.ndarray:
    """:func:`set_id` of each row's distinct tokens."""
    own = _mix((tokens & np.uint64((1 << 63) - 1)) ^ np.uint64(0x5851F42D4C957F2D))
    total = np.concatenate(([np.uint64(0)], np.cumsum(own, dtype=np.uint64)))
    n = np.diff(to)
    return np.where(n > 0, _mix(total[to[1:]] - total[to[:-1]] + n.astype(np.uint64)).view(np.int64), 0)


def sketches(tokens: np.ndarray, to: np.ndarray) -> pa.Array:
    """:func:`sketch` of each row's distinct tokens."""
    n = np.diff(to)
    bits = np.clip(1 << np.frexp(np.maximum(n - 1, 0).astype(float))[1].astype(np.int64), *SKETCH_BITS)
    starts = np.concatenate(([0], np.cumsum(bits)))
    row = np.repeat(np.arange(len(n)), n)
    places = starts[row] + (tokens & (bits[row] - 1).astype(np.uint64)).astype(np.int64)
    data = np.packbits(np.bincount(places, minlength=starts[-1]) & 1, bitorder="little")
    return pa.Array.from_buffers(pa.binary(), len(n), [None, pa.py_buffer((starts // 8).astype(np.int32)), pa.py_buffer(data)])


def differing(x: np.ndarray, y: np.ndarray) -> int:
    """In how many places two sketches (as bytes) differ; the longer one is
    folded to the length of the other."""
    size = min(len(x), len(y))
    x, y = (np.bitwise_xor.reduce(z.reshape(-1, size), axis=0) for z in (x, y))
    return int(np.bitwise_count(x ^ y).sum())


def most_differing(n, m, percent: int):
    """Tokens of one set only, at most, if sets of n and m tokens link."""
    return n + m + 2 * (-percent * (n + m) // (100 + percent))


def similar(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    z = np.sort(np.concatenate((x, y)), kind="stable")
    common = int((z[1:] == z[:-1]).sum())
    return 100 * common >= percent * (len(x) + len(y) - common)


def close_in_blocks(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Pairs of sets of a block with different roots whose sketches are close,
    from rows in the order of their blocks and sizes.  The smaller set is one of
    the block's ``own``; with sides, the two are of different ones."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        blocks = batch.column("block").to_numpy()
        last = int(np.searchsorted(blocks, blocks[-1]))  # the last block may go on
        if held and (last or held[-1].column("block")[-1].as_py() != blocks[0]):
            held.append(batch.slice(0, last))
            yield from _close_pairs(pa.Table.from_batches(held), percent)
            held = []
        elif last:
            yield from _close_pairs(pa.Table.from_batches([batch.slice(0, last)]), percent)
        held.append(batch.slice(last))
    if held:
        yield from _close_pairs(pa.Table.from_batches(held), percent)


def _close_pairs(rows: pa.Table, percent: int) -> Iterator[pa.RecordBatch]:
    block, sid, n, root, side = (rows.column(c).to_numpy() for c in ("block", "sid", "n", "root", "side"))
    own, sketches = rows.column("own").to_numpy(), rows.column("sketch").to_pylist()
    # the rows after each one up to which sizes fit
    number = np.concatenate(([0], np.cumsum(block[1:] != block[:-1])))
    most = n * 100 // percent
    step = int(most.max()) + 1
    ends = np.searchsorted(number * step + n, number * step + most, "right")
    # sketches by their length, with the longer ones that sets of fitting sizes have, folded
    length = np.array([len(x) for x in sketches]) // 8
    fold = 1 << (-(-100 // percent) - 1).bit_length()
    folded = {}
    for size in np.unique(length).tolist():
        place, parts = np.full(len(n), -1), []
        for longer in np.unique(length[(length >= size) & (length <= size * fold)]).tolist():
            at = np.flatnonzero(length == longer)
            place[at] = sum(map(len, parts)) + np.arange(len(at))
            whole = np.frombuffer(b"".join([sketches[i] for i in at]), np.uint64).reshape(len(at), longer // size, size)
            parts.append(np.bitwise_xor.reduce(whole, axis=1))
        folded[size] = place, np.concatenate(parts)
    out, held = [], 0
    first, apart = np.flatnonzero(own & (ends > np.arange(len(n)) + 1)), 1
    while len(first):
        second = first + apart
        fit = (root[first] != root[second]) & ((side[first] < 0) | (side[first] != side[second]))
        i, j = first[fit], second[fit]
        for size, (place, words) in folded.items():
            mine = length[i] == size
            if not mine.any():
                continue
            x, y = i[mine], j[mine]
            for at in range(0, len(x), many := max(1, COMPARED_BYTES // (8 * size))):
                a, b = x[at:at + many], y[at:at + many]
                differ = np.bitwise_count(words[place[a]] ^ words[place[b]]).sum(axis=1, dtype=np.int64)
                near = differ <= most_differing(n[a], n[b], percent)
                if near.any():
                    a, b = a[near], b[near]
                    out.append((block[a], np.minimum(sid[a], sid[b]), np.maximum(sid[a], sid[b]), np.where(sid[a] < sid[b], root[a], root[b]),
                                np.where(sid[a] < sid[b], root[b], root[a]), differ[near]))
                    held += len(a)
        if held >= PAIRS_HELD:
            yield _pair_rows(out)
            out, held = [], 0
        apart += 1
        first = first[ends[first] > first + apart]
    if out:
        yield _pair_rows(out)


def _pair_rows(found: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x), pa.int64()) for x in zip(*found)],
                                      names=["block", "a", "b", "root_a", "root_b", "apart"])


def repeated(tokens: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """The values that occur at least ``least`` times, and how often.  Sorts
    the tokens in their place: no copy of them is made."""
    tokens.sort()
    n = max(len(tokens) - least + 1, 0)
    first = tokens[:n] == tokens[least - 1:least - 1 + n]
    first[1:] &= tokens[1:n] != tokens[:n - 1] if n else first[1:]
    starts = np.flatnonzero(first)
    found = tokens[starts]
    return found, np.searchsorted(tokens, found, "right") - starts


def frequent_tokens(docs: DataFrame, words: int = 5, share: float = FREQUENT_SHARE,
                    chunk: int = FREQUENT_CHUNK) -> np.ndarray:
    """Sorted tokens of the frequent class.

    Tasks count tokens over chunks of documents and tell those in more than
    ``share`` of a chunk; a token in more than that share of all documents is
    told of at least once.  Those whose told counts reach half that share of
    all documents make the class: at most 2 / share times the mean set size,
    whatever the number of documents, so it may come to the driver and go to
    the tasks.  The class only orders tokens; any class gives right results.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, held, n, size = Shingler(words), [], 0, 0

        def told() -> pa.RecordBatch:
            every = np.concatenate(held)
            held.clear()
            every >>= np.uint64(1)
            tokens, counts = repeated(every, math.ceil(max(2, share * n)))
            return pa.RecordBatch.from_pydict({
                "token": np.concatenate((tokens.view(np.int64), [-1])),
                "n": np.concatenate((counts, [n])).astype(np.int64)})

        for batch in slices(batches, "text", SLICE_BYTES):
            shingles, to = distinct(*shingler(batch.column("text")))
            for i in range(batch.num_rows):
                held.append(shingles[to[i]:to[i + 1]])
                n, size = n + 1, size + len(held[-1])
                if n == chunk or size >= CHUNK_TOKENS:
                    yield told()
                    held, n, size = [], 0, 0
        if n:
            yield told()

    counts = materialize(docs.select("text").mapInArrow(run, "token long, n long")
                         .groupBy("token").agg(F.sum("n").alias("n")), "jaccard-frequent")
    total = counts.filter("token = -1").first()
    if total is None:
        return np.zeros(0, np.uint64)
    often = counts.filter((F.col("token") >= 0) & (F.col("n") >= max(2, share * total["n"] / 2)))
    found = np.sort(often.select("token").toArrow().column(0).to_numpy().view(np.uint64))
    discard(counts)
    return found


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 75, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id`` for each row of ``docs``.

    Words are runs of bytes other than ASCII white space, A-Z lower-cased.  A
    set has the distinct ``words``-word shingles; with fewer words the whole
    sequence is the one shingle.  Sets link when 100 * intersection >=
    ``percent`` * union; a component's id is its smallest ``doc_id``.  Null
    and empty texts have empty sets, linked with nothing, so each row is a
    component of its own.  Repeated ids are rows of their own; a null id is
    no component's smallest unless all are null.  Other columns are not read;
    an empty table gives an empty result.  A long text is shingled as a whole
    by the task that holds it.  Sets are known by 64-bit hashes of their
    contents.
    """
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    spark = docs.sparkSession
    frequent = spark.sparkContext.broadcast(frequent_tokens(own, words))  # bounded by the mean set size

    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(words)
        for batch in slices(batches, "text", SLICE_BYTES):
            shingles, to = shingler(batch.column("text"))
            tokens, to = distinct(_tokens(shingles, frequent.value), to)
            n = np.diff(to)
            extended = np.minimum(n, n + (-percent * n) // 100 + 2)  # the prefix and one token more
            ends = np.concatenate(([0], np.cumsum(extended)))
            prefix = tokens[np.repeat(to[:-1] - ends[:-1], extended) + np.arange(ends[-1])].view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(set_ids(tokens, to), pa.int64()),
                 pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(prefix)), sketches(tokens, to)],
                names=["doc_id", "n", "sid", "prefix", "sketch"])

    sets = materialize(own.mapInArrow(prefixes, "doc_id long, n long, sid long, prefix array<long>, sketch binary"), "jaccard-sets")
    rows = sets.filter("n > 0").select("sid", "n", F.explode("prefix").alias("token"))

    # groups of two sets or more.  Tokens outside the frequent class: one shuffle and a look at the neighbours.
    # The frequent class, whose groups are large: partial minimum and maximum, and a join that AQE can split.
    near = Window.partitionBy("token").orderBy("sid")
    every = near.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rare = (rows.filter("token >= 0").withColumn("before", F.lag("sid").over(near))
            .withColumn("lo", F.first("sid").over(every)).withColumn("hi", F.last("sid").over(every))
            .filter("lo < hi and (before is null or before <> sid)").select("sid", "n", "token"))
    often = rows.filter("token < 0").distinct()
    often = materialize(often, "jaccard-often")
    kept = often.groupBy("token").agg(F.min("sid").alias("lo"), F.max("sid").alias("hi")).filter("lo < hi")
    kept = materialize(kept.select("token"), "jaccard-kept")
    groups = materialize(rare.unionByName(often.join(kept, "token").select("sid", "n", "token")), "jaccard-groups")
    for table in (often, kept):  # tables of tokens go when the next one is there
        discard(table)

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(words)
        for batch in slices(batches, "text", SLICE_BYTES):
            shingles, to = shingler(batch.column("text"))
            tokens, to = distinct(shingles >> np.uint64(1), to)
            kept = np.flatnonzero(set_ids(tokens, to) == batch.column("sid").to_numpy())  # a repeated id may have other texts
            out = [tokens[to[i]:to[i + 1]].tobytes() for i in kept]
            yield pa.RecordBatch.from_arrays([batch.column("sid").take(pa.array(kept)), pa.array(out, pa.binary())], names=["sid", "tokens"])

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y, n, m in zip(batch.column("x"), batch.column("y"), batch.column("n").to_pylist(), batch.column("m").to_pylist()):
                found = differing(np.frombuffer(x.as_buffer(), np.uint8), np.frombuffer(y.as_buffer(), np.uint8))
                keep.append(found <= most_differing(n, m, percent))
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(c).filter(mask) for c in ("a", "b")], names=["a", "b"])

    def close_to_centre(tries: DataFrame) -> DataFrame:
        """A table of the pairs of a set and a centre (b) whose sketches are close; the centre is their block."""
        tried = materialize(tries.select("a", "b"), "jaccard-tried")
        inside = tried.select(F.explode(F.array("a", "b")).alias("sid")).distinct()
        signs = materialize(sets.select("sid", "n", "sketch").join(inside, "sid", "left_semi").dropDuplicates(["sid"]), "jaccard-signs")
        left = signs.select(F.col("sid").alias("a"), "n", F.col("sketch").alias("x"))
        right = signs.select(F.col("sid").alias("b"), F.col("n").alias("m"), F.col("sketch").alias("y"))
        near = tried.join(left, "a").join(right, "b").select("a", "b", "x", "y", "n", "m").mapInArrow(close, "a long, b long")
        pairs = materialize(near.selectExpr("b as block", "a", "b", "a as root_a", "b as root_b", "0L as apart"), "jaccard-pairs")
        discard(tried)
        discard(signs)
        return pairs

    def verified(pairs: DataFrame) -> DataFrame:
        """A table of the pairs that link, without those of components that others of them join.  A set is read
        once and goes to each of its blocks, not to each of its pairs; large blocks go to several tasks."""
        if pairs.isEmpty():
            return materialize(pairs.select("a", "b"), "jaccard-links")
        inside = pairs.select(F.explode(F.array("a", "b")).alias("sid")).distinct()
        readers = materialize(sets.select("sid", "doc_id", "n").join(inside, "sid", "left_semi")
                              .groupBy("sid").agg(F.min("doc_id").alias("doc_id"), F.first("n").alias("n")), "jaccard-readers")
        texts = join_small_side(own, readers.select("sid", F.col("doc_id").alias("reader")), F.col("doc_id").eqNullSafe(F.col("reader")))
        contents = materialize(texts.select("sid", "text").mapInArrow(whole, "sid long, tokens binary"), "jaccard-contents")
        in_blocks = pairs.select("block", F.explode(F.array("a", "b")).alias("sid")).distinct()
        parts = in_blocks.join(readers.select("sid", "n"), "sid").groupBy("block").agg(F.ceil(F.sum(F.col("n") * 8) / BLOCK_BYTES).alias("parts"))
        part = [F.pmod(F.xxhash64(c), "parts") for c in ("a", "b")]
        dealt = materialize(pairs.join(parts, "block").withColumn("part", F.xxhash64("block", *part)).select("part", *pairs.columns[1:]), "jaccard-dealt")
        needed = dealt.select(F.col("part").alias("at"), F.explode(F.array("a", "b")).alias("sid")).distinct().join(contents.dropDuplicates(["sid"]), "sid")

        def run(left: pa.Table, right: pa.Table) -> pa.Table:
            tokens = {sid: np.frombuffer(x.as_buffer(), np.uint64) for sid, x in zip(right.column("sid").to_pylist(), right.column("tokens"))}
            parent, links = {}, []

            def find(x: int) -> int:
                while parent.get(x, x) != x:
                    parent[x] = parent.get(parent[x], parent[x])
                    x = parent[x]
                return x
            for a, b, i, j in zip(*(left.sort_by("apart").column(c).to_pylist() for c in ("a", "b", "root_a", "root_b"))):
                i, j = find(i), find(j)
                if i != j and a in tokens and b in tokens and similar(tokens[a], tokens[b], percent):
                    parent[i] = j
                    links.append((a, b))
            return pa.table([pa.array([x[k] for x in links], pa.int64()) for k in (0, 1)], names=["a", "b"])
        found = materialize(dealt.groupBy("part").cogroup(needed.groupBy("at")).applyInArrow(run, "a long, b long"), "jaccard-links")
        for table in (contents, readers, dealt):
            discard(table)
        return found

    def shared_at_least(x: Column, y: Column, first: Column) -> Column:
        """Tokens that the extended prefixes of sets of sizes x and y must
        share, if the prefix of the set of size ``first`` ends first: a token
        of both sets that is not in both prefixes comes after that end, where
        that set has so many tokens."""
        after = F.greatest(F.ceil(first * F.lit(percent) / F.lit(100)) - 2, F.lit(0))
        return F.ceil((x + y) * F.lit(percent) / F.lit(100 + percent)) - after

    def sizes_fit(x: Column, y: Column) -> Column:
        return F.least(x, y) * 100 >= F.greatest(x, y) * percent

    fine = max(math.log(100 / percent), 0.02) / SIZE_CLASSES

    def size_class(n: Column, step: float = fine, shift: Column | float = 0.0) -> Column:
        return F.floor(F.log(n.cast("double")) / F.lit(step) + shift).cast("int")

    def can_link(rooted: DataFrame) -> tuple[DataFrame, DataFrame]:
        """``sid`` and ``least`` of the sets that share enough tokens, over all
        sets of other components in a class of sizes, to link with one: least
        is the number that a pair must share.  Also the table that they read."""
        rooted = rooted.withColumn("class", size_class(F.col("n")))
        present = rooted.groupBy("token", "class").agg(F.min("root").alias("lo"), F.max("root").alias("hi"))
        present = materialize(present.groupBy("token").agg(F.collect_list(F.struct("class", "lo", "hi")).alias("others")), "jaccard-classes")
        other = F.explode(F.filter("others", lambda o: (F.abs(o["class"] - F.col("class")) <= SIZE_CLASSES + 1)
                                   & ((o["lo"] != F.col("root")) | (o["hi"] != F.col("root")))))
        n, c = F.col("n"), F.col("other")
        low, high = F.floor(F.exp(c * fine)), F.ceil(F.exp((c + 1) * fine))
        # only sizes that fit: above the smallest one (if this set's prefix ends first) and below the largest one (else);
        # two, besides, wherever the threshold asks a set of this size for two tokens
        low = F.greatest(low, F.ceil(n * percent / 100))
        high = F.least(high, F.floor(n * 100 / percent))
        least = F.least(shared_at_least(n, low, n), F.floor((n + high) * F.lit(percent / (100 + percent)) - high * F.lit(percent / 100) - 1e-6) + 2)
        least = F.greatest(least, F.least(F.ceil(n * percent / 100), F.lit(2)))
        counts = (rooted.join(present, "token").select("sid", "n", other.alias("o")).select("sid", "n", F.col("o.class").alias("other"))
                  .groupBy("sid", "n", "other").agg(F.count("*").alias("t")).filter((low <= high) & (F.col("t") >= least)))
        return counts.groupBy("sid").agg(F.min(least).alias("least")), present

    links, component = None, None
    open_groups = groups.withColumn("root", F.col("sid"))
    for turn in range(STAR_ROUNDS):
        if open_groups.isEmpty():
            break
        # a set's least-hashed tokens, by several hashes: sets much alike have many of them in common
        seeds = range(turn * STARS, (turn + 1) * STARS)
        least_hashed = [F.struct(F.lit(i).alias("seed"), F.min_by("token", F.xxhash64("token", F.lit(i))).alias("token")) for i in seeds]
        # the share of a set's extended prefix that no other set has, while all groups are there
        length = F.first("n") - F.ceil(F.first("n") * percent / 100) + 2
        rare = F.floor(F.lit(10) - 10 * F.count("*") / length).cast("int") if turn == 0 else F.lit(0)
        # narrow rows are dealt by set first: partial results of so many hashes are larger than the rows
        signed = (open_groups.select("sid", "n", "root", "token").repartition("sid").groupBy("sid")
                  .agg(F.first("n").alias("n"), F.first("root").alias("root"), F.count("*").alias("t"), rare.alias("rare"), F.array(*least_hashed).alias("s"))
                  .select("sid", "n", "root", "t", "rare", F.explode("s").alias("s")).select("sid", "n", "root", "t", "rare", "s.*"))
        # one centre for each token and class of sizes, whose borders lie elsewhere for every other hash
        placed = materialize(signed.withColumn("class", size_class(F.col("n"), fine * SIZE_CLASSES, F.col("seed") % 2 / 2)), "jaccard-signed")
        # one order for all hashes, so that sets of one family agree on their centre
        order = F.struct("rare", F.xxhash64("sid").alias("h"), "root", "sid", "n", "t")
        centre = placed.groupBy("seed", "token", "class").agg(F.min(order).alias("c"))
        # tokens that the two have to share, and as many hashes as a third of that share lets expect
        need = shared_at_least(F.col("n"), F.col("c.n"), F.greatest("n", "c.n"))
        agree = F.lit(STARS / 3) * need / (F.col("t") + F.col("c.t") - need)
        centre = materialize(centre, "jaccard-centres")
        tries = (placed.join(centre, ["seed", "token", "class"])
                 .filter("c.root <> root").filter(sizes_fit(F.col("n"), F.col("c.n"))).filter(need <= F.least("t", "c.t"))
                 .groupBy(F.col("sid").alias("a"), F.col("c.sid").alias("b")).agg(F.count("*").alias("count"), F.first(agree).alias("agree"))
                 .filter("count > 1 and count >= agree")  # a first look; what it misses comes below
                 .groupBy("a").agg(F.max_by("b", F.struct("count", "b")).alias("b")))
        pairs = close_to_centre(tries)
        discard(placed)
        discard(centre)
        found = verified(pairs)
        discard(pairs)
        if found.isEmpty():
            break
        links = found if links is None else links.unionByName(found)
        component = connected_components(links)
        before, open_groups = open_groups, _rooted(open_groups, component)
        discard(before)
    for _ in range(PRUNE_ROUNDS):
        able, classes = can_link(open_groups)
        able = materialize(able, "jaccard-able")
        discard(classes)
        before, open_groups = open_groups, _mixed(open_groups.join(able.select("sid"), "sid", "left_semi"))
        discard(before)

    # what is left: groups with several components.  All groups with one leader, their member of the least hash,
    # make one block: sets that share a token are in its leader's block.
    size = materialize(open_groups.groupBy("token").agg(F.count("*").alias("size"), F.min(F.xxhash64("sid")).alias("block")), "jaccard-sizes")
    heads = open_groups.join(size, "token").groupBy("sid").agg(
        F.first("n").alias("n"), F.first("root").alias("root"), F.array_sort(F.collect_list(F.struct("size", "token", "block"))).alias("own"))
    # of the tokens that a pair shares, those of small groups first, the first one has least - 1 more behind it, in both sets
    first = F.slice("own", F.lit(1), F.greatest(F.size("own") - F.greatest("least", F.lit(1)) + 1, F.lit(0)).cast("int"))
    heads = heads.join(able, "sid").select("sid", "n", "root", F.array_distinct(F.transform(first, lambda o: o["block"])).alias("blocks"))
    heads = materialize(heads.filter(F.size("blocks") > 0).join(sets.select("sid", "sketch"), "sid").dropDuplicates(["sid"]), "jaccard-heads")
    for table in (open_groups, size, able):
        discard(table)
    placed = heads.select("sid", "n", "root", "sketch", F.explode("blocks").alias("block"))
    mixed = placed.groupBy("block").agg(F.count("*").alias("sets"), F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo < hi")
    mixed = materialize(mixed.select("block", F.ceil(F.col("sets") / LARGE_GROUP).cast("int").alias("parts")), "jaccard-blocks")
    # a large block by classes of sizes, in which the smaller set of a pair is (the larger one is of that class or
    # the next), and by two of its parts
    placed = placed.join(mixed, "block").withColumn("class", size_class(F.col("n"), fine * SIZE_CLASSES)) \
        .withColumn("side", F.pmod(F.xxhash64("sid", F.lit(1)), "parts").cast("int"))
    cells = F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda o: F.struct(F.least("side", o).alias("i"), F.greatest("side", o).alias("j")))
    cells = F.flatten(F.transform(F.array(F.col("class"), F.col("class") - 1), lambda c: F.transform(cells, lambda o: F.struct(c.alias("class"), o["i"].alias("i"), o["j"].alias("j")))))
    cells = F.when(F.col("parts") > 1, cells).otherwise(F.array(F.struct(F.col("class").alias("class"), F.lit(0).alias("i"), F.lit(0).alias("j"))))
    celled = placed.withColumn("cell", F.explode(cells)).select(
        F.when(F.col("parts") > 1, F.xxhash64("block", "cell.class", "cell.i", "cell.j")).otherwise(F.col("block")).alias("block"), "sid", "n", "root",
        (F.col("class") == F.col("cell.class")).alias("own"), F.when(F.col("cell.i") < F.col("cell.j"), F.col("side")).otherwise(-1).alias("side"), "sketch")
    near = celled.repartition("block").sortWithinPartitions("block", "n").mapInArrow(
        lambda batches: close_in_blocks(batches, percent), "block long, a long, b long, root_a long, root_b long, apart long")
    pairs = materialize(near.dropDuplicates(["a", "b"]), "jaccard-pairs")
    for table in (heads, mixed):
        discard(table)
    found = verified(pairs)
    discard(pairs)
    if not found.isEmpty():
        component = connected_components(found if links is None else links.unionByName(found))
    if component is None:
        component = connected_components(found)

    rooted = materialize(
        sets.select("doc_id", "n", "sid").join(component.select(F.col("node").alias("sid"), "root"), "sid", "left")
        .select("doc_id", F.col("n").alias("n_shingles"), "sid", F.coalesce("root", "sid").alias("root")),
        "jaccard-rooted")
    first = rooted.filter("sid <> 0").groupBy("root").agg(F.min("doc_id").alias("first"))
    return rooted.join(first, (rooted["root"] == first["root"]) & (rooted["sid"] != 0), "left").select(
        "doc_id", "n_shingles", F.coalesce("first", "doc_id").alias("component_id"))


def _rooted(groups: DataFrame, component: DataFrame) -> DataFrame:
    """Groups' rows with their component's root."""
    rooted = (groups.drop("root").join(component.select(F.col("node").alias("sid"), "root"), "sid", "left")
              .select("token", "sid", "n", F.coalesce("root", "sid").alias("root")))
    rooted = materialize(rooted, "jaccard-rooted")
    mixed = _mixed(rooted)
    discard(rooted)
    return mixed


def _mixed(rooted: DataFrame) -> DataFrame:
    """A table of the rows of groups that hold more than one component."""
    mixed = rooted.groupBy("token").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo < hi")
    mixed = materialize(mixed.select("token"), "jaccard-mixed")
    out = materialize(rooted.join(mixed, "token"), "jaccard-open")
    discard(mixed)
    return out
