"""Benchmark passages in documents, by templates of word windows.

Words are runs of letters and digits (with ``.`` and ``,`` between digits),
lower-cased.  A template puts typed placeholders for numbers, names (words
with a capital first letter) and units (a known unit after a number); the
replaced words are the template's slot values.  Windows of ``window`` words of
the benchmark are indexed twice: as they are, and as templates; items with
fewer words are one window each, and documents make windows of those lengths
too.  A template window counts if at least half of its words are literal, and if its slots are
consistent with the benchmark's: one value always becomes the same other value
and no two become the same one, over all matched windows of a document and an
item, so a question with other numbers or names is found and unrelated text
with the same frame is not.

The benchmark's hashes make a bit set of fixed size that tasks test their
windows against; what passes is joined with the benchmark's windows by hash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.jaccard import _BASE, _BASE_INVERSE, _mix, _powers
from marquee.llm.text_arrow import slices, text_bytes
from marquee.session import materialize

WINDOW = 8
FILTER_BITS = 25
SLICE_BYTES = 256 << 10
# Units, in lower case, that count as such after a number.
UNITS = """
mm cm m km in ft yd mi inch inches foot feet yard yards mile miles meter meters metre metres
kilometer kilometers kilometre kilometres centimeter centimeters
mg g kg lb lbs oz gram grams kilogram kilograms pound pounds ounce ounces ton tons tonnes
ml l liter liters litre litres gallon gallons cup cups
s sec second seconds min minute minutes h hr hour hours day days week weeks month months year years
percent degrees degree dollars dollar cents cent euros euro
mph kmh hz khz mhz ghz kb mb gb tb w kw v a
""".split()

_BYTE = np.random.default_rng(4021).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_WORD = _DIGIT | _UPPER
_WORD[97:123] = True
_WORD[128:] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_NUMBER, _NAME, _UNIT = (np.uint64(x) for x in (0x1111111111111111, 0x2222222222222222, 0x3333333333333333))


class Words:
    """Words of texts: where they are, their hashes and their placeholders."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)
        self.units = np.zeros(0, np.uint64)
        self.units = np.unique(self("".join(u + " " for u in UNITS).encode())[3])

    def __call__(self, raw: bytes | np.ndarray, offsets: np.ndarray | None = None):
        """(starts, ends, lower-cased bytes, literal hashes, template hashes)
        of the words of all texts in a byte array."""
        data = np.frombuffer(raw, np.uint8) if isinstance(raw, bytes) else raw
        n = len(data)
        offsets = np.array([0, n]) if offsets is None else offsets
        if not n:
            none = np.zeros(0, np.int64)
            return none, none, data, none.astype(np.uint64), none.astype(np.uint64)
        low, word, digit = _LOWER[data], _WORD[data], _DIGIT[data]
        high = np.flatnonzero(data[:-1] == 0xC3) + 1  # capital Latin-1 letters, as two bytes of UTF-8
        high = high[(data[high] >= 0x80) & (data[high] <= 0x9E) & (data[high] != 0x97)]
        low[high] += 32
        if n > 2:
            point = np.flatnonzero(((data[1:-1] == 46) | (data[1:-1] == 44)) & digit[:-2] & digit[2:]) + 1
            edge = np.isin(point, offsets) | np.isin(point + 1, offsets)
            word[point[~edge]] = True
        cut = np.zeros(n + 1, bool)
        cut[offsets] = True
        starts = np.flatnonzero(word & (np.concatenate(([True], ~word[:-1])) | cut[:-1]))
        ends = np.flatnonzero(word & (np.concatenate((~word[1:], [True])) | cut[1:])) + 1
        if n >= len(self.up):
            self.up, self.down = _powers(_BASE, n + 1), _powers(_BASE_INVERSE, n + 1)
        total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_BYTE[low] * self.up[:n], dtype=np.uint64)))
        literal = _mix((total[ends] - total[starts]) * self.down[starts] + (ends - starts).astype(np.uint64))
        upper = _UPPER[data]
        upper[high - 1] = True
        number = digit[starts] if len(starts) else np.zeros(0, bool)
        unit = np.zeros(len(starts), bool)
        unit[1:] = number[:-1] & np.isin(literal[1:], self.units) & ~cut_between(cut, ends, starts)
        template = np.where(number, _NUMBER, np.where(unit, _UNIT, np.where(upper[starts], _NAME, literal)))
        return starts, ends, low, literal, template


def cut_between(cut: np.ndarray, ends: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Whether a text ends between a word and the next one."""
    count = np.cumsum(cut)
    return count[starts[1:]] != count[np.maximum(ends[:-1] - 1, 0)]


def windows(found, offsets: np.ndarray, size: int, whole: bool):
    """(text, first word, place, number of words, literal hash, template hash,
    whether the template may be used) of all windows of the ``found`` words; a
    text with fewer words has one window of all of them if ``whole``, or none."""
    starts, _, _, literal, template = found
    first = np.searchsorted(starts, offsets)
    count = np.diff(first)
    made = np.where(count >= size, count - size + 1, np.minimum(count, int(whole)))
    to = np.cumsum(made)
    text = np.repeat(np.arange(len(count)), made)
    at = first[:-1][text] + np.arange(to[-1] if len(to) else 0) - (to - made)[text]
    own = np.minimum(count[text], size)
    pad = np.zeros(size, np.uint64)
    lit, tem, slot = np.concatenate((literal, pad)), np.concatenate((template, pad)), np.concatenate((literal != template, pad > 0))
    a, b, slots = np.zeros(len(at), np.uint64), np.zeros(len(at), np.uint64), np.zeros(len(at), np.int64)
    steps = _mix(np.arange(11, 11 + size, dtype=np.uint64)) | np.uint64(1)
    for j in range(size):
        inside = own > j
        a += np.where(inside, lit[at + j], 0) * steps[j]
        b += np.where(inside, tem[at + j], 0) * steps[j]
        slots += inside & slot[at + j]
    mark = own.astype(np.uint64)
    return text, at, at - first[:-1][text], own, _mix(a + mark), \
        _mix(b + mark + np.uint64(1 << 20)), (slots > 0) & (2 * slots <= own)


def _rows(words: Words, batch: pa.RecordBatch, sizes: list[int], whole: bool, passes) -> Iterator[pa.RecordBatch]:
    """Windows of each of the sizes of a batch's texts that pass, as rows."""
    data, offsets = text_bytes(batch.column("text"))
    found = words(data, offsets)
    low = found[2].tobytes()
    for size in sizes:
        yield _passed(batch, found, low, windows(found, offsets, size, whole), passes)


def _passed(batch: pa.RecordBatch, found, low: bytes, made, passes) -> pa.RecordBatch:
    starts, ends, _, literal, template = found
    slot = literal != template
    text, at, place, own, a, b, usable = made
    one, two = np.flatnonzero(passes(a)), np.flatnonzero(usable & passes(b))
    slots: list[list[str]] = [[] for _ in one]
    for i in two.tolist():
        slots.append([low[starts[k]:ends[k]].decode("utf-8", "replace")
                      for k in range(at[i], at[i] + own[i]) if slot[k]])
    pick = np.concatenate((one, two))
    return pa.RecordBatch.from_pydict({
        "id": batch.column("id").take(pa.array(text[pick])), "place": pa.array(place[pick], pa.int64()),
        "n_words": pa.array(own[pick], pa.int64()),
        "hash": pa.array(np.concatenate((a[one], b[two])).view(np.int64)),
        "slots": pa.array(slots, pa.list_(pa.string()))})


_ROW = "id long, place long, n_words long, hash long, slots array<string>"


def benchmark_windows(benchmark: DataFrame, window: int = WINDOW, id_col: str = "item_id",
                      text_col: str = "text") -> DataFrame:
    """All windows of the benchmark's items."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words()
        for batch in slices(batches, "text", SLICE_BYTES):
            yield from _rows(words, batch, [window], True, lambda h: np.ones(len(h), bool))
    own = benchmark.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return own.mapInArrow(run, _ROW).withColumnsRenamed({"id": "item_id", "place": "item_place", "slots": "item_slots"})


def find_leaks(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, min_words: int = WINDOW,
               filter_bits: int = FILTER_BITS, id_col: str = "doc_id", text_col: str = "text",
               item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """``doc_id``, ``item_id``, ``n_windows`` (of the item, that are matched),
    ``verbatim`` (all of them literally, but for case) for each benchmark item
    of which a document has a passage.

    A passage is ``window`` consecutive words, or the whole item if it has
    fewer, anywhere in the document, but at least half of ``min_words``: an
    item of three words is no evidence.  Null and empty texts have no windows; rows with equal ids
    are taken together; null ids are their own; other columns of either table,
    whatever their names, are not read; empty tables on either side give an
    empty result.  A long text is looked at as a whole: a task holds one slice
    of texts, or one text if that is longer.
    """
    index = materialize(benchmark_windows(benchmark, window, item_col, item_text_col)
                        .filter(F.col("n_words") * 2 >= min_words), "leak-index")
    mask = (1 << filter_bits) - 1
    bits = (index.select(F.col("hash").bitwiseAND(mask).alias("h")).distinct()
            .groupBy(F.shiftright("h", 6).alias("w")).agg(F.expr("bit_or(shiftleft(1L, cast(h & 63 as int)))").alias("b")).collect())
    table = np.zeros(1 << (filter_bits - 6), np.uint64)  # a fixed size, whatever the benchmark's
    for r in bits:
        table[r["w"]] = r["b"] & 0xFFFFFFFFFFFFFFFF
    shared = docs.sparkSession.sparkContext.broadcast(table)
    # whole items of fewer words: windows of their lengths, less than ``window`` different ones
    sizes = [window, *sorted(r["n_words"] for r in index.filter(F.col("n_words") < window).select("n_words").distinct().collect())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, table = Words(), shared.value

        def passes(h: np.ndarray) -> np.ndarray:
            own = h & np.uint64(mask)
            return (table[own >> np.uint64(6)] >> (own & np.uint64(63)) & np.uint64(1)).astype(bool)
        for batch in slices(batches, "text", SLICE_BYTES):
            yield from _rows(words, batch, sizes, False, passes)

    own = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    hits = own.mapInArrow(run, _ROW).withColumnRenamed("id", "doc_id")
    both = hits.join(index, ["hash", "n_words"])
    both = both.filter(F.size("slots") == F.size("item_slots")) \
        .withColumn("pairs", F.array_distinct(F.arrays_zip("slots", "item_slots")))
    # an alignment: the same distance between a document's and an item's words
    lines = both.groupBy("doc_id", "item_id", (F.col("place") - F.col("item_place")).alias("shift")).agg(
        F.array_distinct(F.flatten(F.collect_set("pairs"))).alias("pairs"),
        F.collect_set("item_place").alias("at"),
        F.collect_set(F.when(F.size("slots") == 0, F.col("item_place"))).alias("literal"))
    # slots in one alignment: each value has one partner on the other side
    even = (F.size(F.array_distinct("pairs.slots")) == F.size("pairs")) & \
        (F.size(F.array_distinct("pairs.item_slots")) == F.size("pairs"))
    lines = lines.withColumn("at", F.when(even, F.col("at")).otherwise(F.col("literal"))).filter(F.size("at") > 0)
    return lines.groupBy("doc_id", "item_id").agg(
        F.array_distinct(F.flatten(F.collect_list("at"))).alias("at"),
        F.array_distinct(F.flatten(F.collect_list("literal"))).alias("literal")).select(
        "doc_id", "item_id", F.size("at").cast("long").alias("n_windows"),
        (F.size("at") == F.size("literal")).alias("verbatim"))
