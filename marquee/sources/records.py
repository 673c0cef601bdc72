"""Records that reach over the borders of byte ranges.

The text source splits a file by byte ranges and yields chunks that end at a
separator (a line break, the end tag of a feed entry).  A separator inside a
quoted cell, a CDATA section or a comment ends no record, and whether one is
inside cannot be told from its range alone.  So each chunk is described by its
end state for every start state (state 0: a record begins), and

1. each range reports its end state for every start state, in one pass whose
   result is a row for each range;
2. the ranges of a file are combined in order, which gives every range its
   true start state and the range in which its open record began;
3. each range is read again from its true start state and cut into records.
   The parts of records that reach over ranges, at most two for each range,
   are put together by the place where they began.

No data is shuffled but those parts, no file is one task, and only rows about
ranges are held for a file or broadcast.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.operators.joins import BROADCAST_MAX_BYTES
from marquee.session import materialize


#: Bytes of a range's row in memory, counted amply.
RANGE_BYTES = 64


def end_states(states: int, step: Callable[[Column, Column], Column], tokens: Column, first: Callable[[int], Column]) -> Column:
    """A chunk's code: its end state for every start state, as digits to base
    ``states``.  ``step(state, token)`` is folded over ``tokens``, beginning
    with ``first(start)``."""
    code = F.lit(0)
    for start in range(states):
        code = code + F.reduce(tokens, first(start), step) * states ** start
    return code.cast("int")


def identity(states: int) -> int:
    """The code of a chunk that leaves every state as it is."""
    return sum(s * states ** s for s in range(states))


def _digits(code: int, states: int) -> list[int]:
    return [code // states ** s % states for s in range(states)]


def _portions(batch: pa.RecordBatch) -> Iterator[tuple[int, int, int, int]]:
    """(file, block, from, to) of the batch's parts of one range each."""
    file, block = batch.column("file").to_numpy(), batch.column("block").to_numpy()
    if not len(file):
        return
    new = np.flatnonzero((file[1:] != file[:-1]) | (block[1:] != block[:-1])) + 1
    for i, j in zip([0, *new.tolist()], [*new.tolist(), len(file)]):
        yield int(file[i]), int(block[i]), i, j


def _report(states: int):
    """Ranges with their end states, and whether a record begins in them, for
    every start state."""
    same = identity(states)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, now, opens = None, [], []

        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({
                "file": [at[0]], "block": [at[1]], "ends": pa.array([now], pa.list_(pa.int32())),
                "opens": pa.array([opens], pa.list_(pa.bool_()))})

        for batch in batches:
            codes = batch.column("code").to_numpy()
            for file, block, i, j in _portions(batch):
                if at != (file, block):
                    if at:
                        yield row()
                    at, now, opens = (file, block), list(range(states)), [False] * states
                opens = [o or s == 0 for o, s in zip(opens, now)]
                changing = np.flatnonzero(codes[i:j] != same)
                for k, code in zip(changing.tolist(), codes[i:j][changing].tolist()):
                    to = _digits(code, states)
                    now = [to[s] for s in now]
                    if k < j - i - 1:
                        opens = [o or s == 0 for o, s in zip(opens, now)]
        if at:
            yield row()
    return run


def _combined(ranges: pd.DataFrame) -> pd.DataFrame:
    """The true start state of each range of a file, and where the record that
    is open there began."""
    state, owner, rows = 0, -1, []
    for r in ranges.sort_values("block").itertuples():
        end = r.ends[state]
        rows.append((r.file, r.block, state, owner if state else -1, state != 0 or end != 0))
        owner = r.block if r.opens[state] else owner
        state = end
    return pd.DataFrame(rows, columns=["file", "block", "start", "owner", "cut"])


def _cut(states: int, sep: str, parts: bool):
    """Whole records of the ranges, or (``parts``) the parts of the others."""
    same = identity(states)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, state, owner, is_first, pending, found = None, 0, -1, False, [], []
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.string())

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows), kinds)],
                                              names=["file", "owner", "block", "first", "value"])

        for batch in batches:
            codes, starts = batch.column("code").to_numpy(), batch.column("start").to_numpy()
            values, owners = batch.column("value"), batch.column("owner")
            for file, block, i, j in _portions(batch):
                if at != (file, block):
                    if pending:  # still open at the range's end
                        found.append((at[0], owner, at[1], is_first, sep.join(pending)))
                    at, state, owner, pending = (file, block), int(starts[i]), owners[i].as_py(), []
                    is_first, seen = False, block > 0
                before = np.empty(j - i, np.int8)  # the state that each chunk begins in
                last = 0
                changing = np.flatnonzero(codes[i:j] != same)
                for k, code in zip(changing.tolist(), codes[i:j][changing].tolist()):
                    before[last:k + 1] = state
                    state, last = code // states ** state % states, k + 1
                before[last:] = state
                heads = np.flatnonzero(before == 0)
                head = int(heads[0]) if len(heads) else j - i
                pending.extend(values.slice(i, head).to_pylist())  # more of the record that is open
                if pending and (len(heads) or state == 0):
                    row = (file, owner, block, is_first, sep.join(pending))
                    if owner != block:
                        found.append(row)
                    elif not parts:  # begun in an earlier batch of this range
                        yield batch_of([row])
                    pending = []
                if not len(heads):
                    continue
                ends = np.concatenate((heads, [j - i]))
                if state:  # the last record goes on
                    pending = values.slice(i + int(heads[-1]), j - i - int(heads[-1])).to_pylist()
                    ends, heads = heads, heads[:-1]
                n = len(heads)
                if n and not parts:
                    lists = pa.ListArray.from_arrays(pa.array((ends - ends[0]).astype(np.int32)),
                                                     values.slice(i + int(ends[0]), int(ends[-1] - ends[0])))
                    firsts = np.zeros(n, bool)
                    firsts[0] = not seen
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(n, file)), pa.array(np.full(n, block)), pa.array(np.full(n, block)),
                         pa.array(firsts), pc.binary_join(lists, sep)],
                        names=["file", "owner", "block", "first", "value"])
                is_first, seen, owner = not seen and not n, True, block
        if pending:
            found.append((at[0], owner, at[1], is_first, sep.join(pending)))
        for k in range(0, len(found) if parts else 0, 1000):
            yield batch_of(found[k:k + 1000])
    return run


def joined_records(spark: SparkSession, files: list[str], sep: str, states: int,
                   code: Callable[[Column], Column], max_bytes: int = BROADCAST_MAX_BYTES) -> tuple[DataFrame, int]:
    """Records of text ``files`` and the number of byte ranges they are in.

    Columns: ``file`` (hash of its path), ``block`` (start of the byte range
    that the record begins in), ``first`` (whether it is its file's first) and
    ``value``, without the separator at its end.  ``code`` gives a chunk's
    :func:`end_states`.  A record that is open at the end of its file ends
    there; empty files have none.

    Ranges are reported when this is called.  Their rows are broadcast to the
    second pass; if there are more than ``max_bytes`` of them, halves of the
    files are read one by one and appended.
    """
    path, block = F.col("_metadata.file_path"), F.col("_metadata.file_block_start")
    chunks = spark.read.option("lineSep", sep).text(files).select("value", F.xxhash64(path).alias("file"), block.alias("block"))
    own_code = code(F.col("value")).alias("code")
    reports = chunks.select("file", "block", own_code).mapInArrow(
        _report(states), "file long, block long, ends array<int>, opens array<boolean>")
    ranges = materialize(reports.groupBy("file").applyInPandas(
        _combined, "file long, block long, start int, owner long, cut boolean"), "record-ranges")
    n = ranges.count()
    if n * RANGE_BYTES > max_bytes and len(files) > 1:
        half = len(files) // 2
        (a, n_a), (b, n_b) = (joined_records(spark, own, sep, states, code, max_bytes) for own in (files[:half], files[half:]))
        return a.unionByName(b), n_a + n_b
    placed = chunks.join(F.broadcast(ranges), ["file", "block"])  # a row for each byte range: keeps the chunks' order
    out = "file long, owner long, block long, first boolean, value string"
    columns = ["value", "file", "block", own_code, "start", "owner"]  # codes of the joined chunks only
    whole = placed.select(*columns).mapInArrow(_cut(states, sep, False), out)
    cut = (placed.filter("cut").select(*columns).mapInArrow(_cut(states, sep, True), out)
           .groupBy("file", "owner").agg(F.max("first").alias("first"), F.array_sort(F.collect_list(F.struct("block", "value"))).alias("p"))
           .select("file", "owner", "first", F.array_join(F.col("p.value"), sep).alias("value")))
    return whole.select("file", "owner", "first", "value").unionByName(cut).withColumnRenamed("owner", "block"), n
