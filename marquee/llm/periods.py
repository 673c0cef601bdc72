"""Periodic runs of words, by a dictionary of basic factors.

The dictionary names the factors (stretches of words) of each power-of-two
length that occur repeatedly in a text: a factor of 2^(k+1) words is the pair
of its halves' names.  For each length, occurrences of one factor are taken in
order; where three or more follow each other at one distance of at most twice
that length, they are an arithmetic progression and propose its difference as
a period.  The dictionary then extends each proposal as far as the period
holds, one power of two after another on each side.  Proposals that come to
the same stretch are one run; the smallest of their periods is its period.

A run of period q and at least 4 q words is always proposed: take the least
power of two h >= q.  Inside the run, factors of h words are equal at
distances that are multiples of q and at no others (q is its smallest period),
and with h < 2 q three of them fit, q apart.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.text_arrow import slices

SLICE_BYTES = 1 << 20


def basic_factors(words: np.ndarray, ends: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For factors of 1, 2, 4, ... words: their names by position, and the
    positions of repeated ones, ordered by name and then position.

    ``ends[i]`` is the end of the text that word i belongs to; factors of
    different texts have different names.  A factor that is not repeated in
    its text, or would reach over its end, has a negative name of its own: no
    longer factor from that position is repeated either.
    """
    n = len(words)
    spare = -1 - np.arange(n, dtype=np.int64)
    at, key, length = np.arange(n), ends * (int(words.max(initial=0)) + 1) + words, 1
    while len(at):
        order = np.argsort(key, kind="stable")
        at, key = at[order], key[order]
        new = np.concatenate(([True], key[1:] != key[:-1]))
        name = np.cumsum(new) - 1
        often = np.bincount(name)[name] > 1
        at, name = at[often], name[often]
        if not len(at):
            return
        names = spare.copy()
        names[at] = name
        yield names, at
        at = np.sort(at)
        at = at[at + 2 * length <= ends[at]]
        at = at[names[at + length] >= 0]
        key = names[at] * n + names[at + length]
        length *= 2


def find_runs(words: np.ndarray, ends: np.ndarray, min_exponent: int,
              min_length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, lengths and smallest periods of all maximal runs, by start and
    then period."""
    levels, first, period = [], [], []
    for k, (names, at) in enumerate(basic_factors(words, ends)):
        levels.append(names)
        gap = np.diff(at)
        gap[(names[at[1:]] != names[at[:-1]]) | (gap > 2 << k)] = 0
        goes_on = (gap[1:] == gap[:-1]) & (gap[1:] > 0)
        begins = goes_on & ~np.concatenate(([False], goes_on[:-1]))[:len(goes_on)]
        first.append(at[np.flatnonzero(begins)])
        period.append(gap[np.flatnonzero(begins)])
    if not levels:
        return (np.zeros(0, np.int64),) * 3
    first, period = np.concatenate(first), np.concatenate(period)
    left, right = first.copy(), first.copy()
    for k in range(len(levels) - 1, -1, -1):  # no equal factors are longer than those of the last level twice
        names, step = levels[k], 1 << k
        other = np.minimum(right + period, len(words) - 1)
        right += step * ((names[right] == names[other]) & (other == right + period))
        back = np.maximum(left - step, 0)
        left -= step * ((names[back] == names[back + period]) & (left >= step))
    length = right + period - left
    own = length >= np.maximum(min_length, min_exponent * period)
    left, length, period = left[own], length[own], period[own]
    order = np.lexsort((period, length, left))
    left, length, period = left[order], length[order], period[order]
    new = np.ones(len(left), bool)
    new[1:] = (left[1:] != left[:-1]) | (length[1:] != length[:-1])
    left, length, period = left[new], length[new], period[new]
    order = np.lexsort((period, left))
    return left[order], length[order], period[order]


def periodic_runs(docs: DataFrame, min_exponent: int = 4, min_length: int = 6,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``n_words``, ``runs`` and ``collapsed`` for each row.

    Words are runs of characters other than ASCII white space.  ``runs`` holds
    every maximal run of at least ``min_length`` words and ``min_exponent``
    periods, as (start, length, period) in order of start and period, words
    numbered from 0; the period is the smallest one.  ``collapsed`` has the
    words that no run repeats (each run keeps the words of its first period,
    unless another run drops them), joined by one space.

    Null, empty and blank texts have no words, no runs and an empty
    ``collapsed``; a null id stays null; repeated rows give repeated rows; an
    empty table gives an empty result; other columns are not read.  A long
    text is looked at as a whole: a task holds one slice of texts, or one
    text if that is longer, and a few numbers for each of its words.
    """
    if min_exponent < 4:
        raise ValueError("runs of fewer than four periods may go without a proposal")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SLICE_BYTES):
            texts = [(t.as_py() or "").encode().split() for t in batch.column("text")]
            sizes = np.fromiter(map(len, texts), np.int64, len(texts))
            to = np.cumsum(sizes)
            words = pa.array([w for t in texts for w in t], pa.binary()).dictionary_encode()
            ids = words.indices.to_numpy(zero_copy_only=False).astype(np.int64)
            start, length, period = find_runs(ids, np.repeat(to, sizes), min_exponent, min_length)
            gone = np.zeros(len(ids) + 1, np.int64)
            np.add.at(gone, start + period, 1)
            np.add.at(gone, start + length, -1)
            gone = np.cumsum(gone)[:-1] > 0
            text_of = np.searchsorted(to, start, side="right")
            runs = np.concatenate(([0], np.cumsum(np.bincount(text_of, minlength=len(texts)))))
            shorter = np.zeros(len(texts), bool)
            shorter[text_of] = True
            collapsed = []
            for i, own in enumerate(texts):
                if shorter[i]:
                    lost = gone[to[i] - sizes[i]:to[i]].tolist()
                    own = [w for w, x in zip(own, lost) if not x]
                collapsed.append(b" ".join(own))
            triples = pa.StructArray.from_arrays(
                [pa.array(start - (to - sizes)[text_of]), pa.array(length), pa.array(period)],
                names=["start", "length", "period"])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes),
                 pa.ListArray.from_arrays(pa.array(runs.astype(np.int32)), triples),
                 pa.array(collapsed, pa.binary()).cast(pa.string())],
                names=["doc_id", "n_words", "runs", "collapsed"])

    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return own.mapInArrow(
        run, "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string")


def greatest_run(runs: str = "runs"):
    """The run with the greatest length by period, compared exactly; the first
    of equal ones.  Null without runs."""
    return F.reduce(runs, F.expr("CAST(NULL AS struct<start: bigint, length: bigint, period: bigint>)"),
                    lambda best, r: F.when(best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"]), r)
                    .otherwise(best))
