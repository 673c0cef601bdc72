"""Removal of repeated runs of lines, with built-in functions only.

The lines of all texts are sequences of line ids.  Their suffix array is built
by prefix doubling over tables: the rank of a suffix by its first 2h lines
comes from the pair of its rank by h lines and the rank of the suffix h lines
on.  Suffixes of the same rank are one interval of the array whose longest
common prefix is at least that long; the interval has the places of one
repeated run, and the smallest is its first copy.  A suffix whose rank nobody
shares is in its final place and leaves, so a round costs as much as there are
repeated lines left, and the rounds end with the longest repeated run.

Ranks follow the order of the pairs: the different pairs are sorted over all
tasks and numbered in that order, so no task sees them all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marquee.operators.joins import join_small_side
from marquee.session import materialize

MIN_LINES = 2
LONG_WORDS = 50  # for ``min_words``: words (between white space) with which one line is a passage by itself
_KEY = ["doc", "content"]


def _line_ids(docs: DataFrame) -> DataFrame:
    ids = F.transform(F.split("text", "\n", -1), lambda line: F.xxhash64(line))
    return docs.select(*_KEY, F.posexplode(ids).alias("line", "rank"))


def _ranked(suffixes: DataFrame, by: list[str]) -> DataFrame:
    """Suffixes that share ``by`` with another one, with the rank of ``by``,
    the size of its interval and the first place in it."""
    place = F.struct(*_KEY, "line")
    shared = suffixes.groupBy(*by).agg(F.count("*").alias("size"), F.min(place).alias("first")).filter("size > 1")
    order = shared.orderBy(*by).withColumn("next_rank", F.monotonically_increasing_id())
    out = suffixes.join(order, by).select(*_KEY, "line", F.col("next_rank").alias("rank"), "size", "first")
    return materialize(out, "lines-suffixes")


def _pair(suffixes: DataFrame, step: int) -> DataFrame:
    """Suffixes with the rank of the suffix ``step`` lines on, if it is shared."""
    on = Window.partitionBy(*_KEY).orderBy("line").rangeBetween(step, step)
    return suffixes.select(*_KEY, "line", F.col("rank").alias("r1"), F.first("rank").over(on).alias("r2")) \
        .filter(F.col("r2").isNotNull())


def suffix_intervals(docs: DataFrame, min_lines: int = MIN_LINES) -> tuple[DataFrame, list[tuple[int, DataFrame]]]:
    """Intervals of suffixes with a common prefix of at least ``min_lines``,
    and those of each doubling round as (lines, suffixes).

    Each table has one row for a suffix: ``doc``, ``content``, ``line``,
    ``rank``, ``size`` and ``first`` of its interval.
    """
    have, current = 1, _ranked(_line_ids(docs), ["rank"])
    rounds, wanted = [(1, current)], current if min_lines == 1 else None
    while True:
        if wanted is None and min_lines < 2 * have:
            wanted = _ranked(_pair(current, min_lines - have), ["r1", "r2"])  # two overlapping halves
        if current.isEmpty():
            break
        current = _ranked(_pair(current, have), ["r1", "r2"])
        have *= 2
        rounds.append((have, current))
        if have == min_lines:
            wanted = current
    return (current if wanted is None else wanted), rounds


def _long_lines(docs: DataFrame, min_words: int) -> DataFrame:
    """Ids of the lines of at least ``min_words`` words."""
    words = F.size(F.split(F.trim(F.regexp_replace("text", r"\s+", " ")), " ", -1))
    return (docs.select(*_KEY, F.posexplode(F.split("text", "\n", -1)).alias("line", "text"))
            .filter(F.length("text") >= 2 * min_words - 1).filter(words >= min_words)
            .select(*_KEY, "line", F.xxhash64("text").alias("rank")))


def repeated_runs(docs: DataFrame, min_lines: int = MIN_LINES, min_words: int | None = None) -> DataFrame:
    """Runs of lines to delete: ``doc``, ``content``, ``start``, ``end``
    (exclusive), ``longest``: the longest prefix of whole doublings that the
    run's suffixes share with another place."""
    shared, rounds = suffix_intervals(docs, min_lines)
    is_later = F.struct(*_KEY, "line") != F.col("first")
    later = shared.filter(is_later).select(*_KEY, "line", (F.col("line") + min_lines).alias("end"))
    if min_words is not None:
        alone = _ranked(_long_lines(docs, min_words), ["rank"]).filter(is_later)
        later = later.unionByName(alone.select(*_KEY, "line", (F.col("line") + 1).alias("end")))
        later = later.groupBy(*_KEY, "line").agg(F.max("end").alias("end"))
    depth = None
    for have, suffixes in rounds:
        own = suffixes.select(*_KEY, "line", F.lit(have).alias("depth"))
        depth = own if depth is None else depth.unionByName(own)
    depth = depth.groupBy(*_KEY, "line").agg(F.max("depth").alias("depth"))
    near = Window.partitionBy(*_KEY).orderBy("line")
    later = later.join(depth, [*_KEY, "line"], "left")
    before = F.max("end").over(near.rowsBetween(Window.unboundedPreceding, -1))
    later = later.withColumn("new", (F.col("line") > F.coalesce(before, F.lit(-1))).cast("int"))
    later = later.withColumn("run", F.sum("new").over(near))
    return later.groupBy(*_KEY, "run").agg(
        F.min("line").alias("start"), F.max("end").alias("end"), F.max("depth").alias("longest")).drop("run")


def dedup_lines(docs: DataFrame, min_lines: int = MIN_LINES, id_col: str = "doc_id",
                text_col: str = "text", min_words: int | None = None) -> DataFrame:
    """``docs`` without the later copies of repeated runs of lines.

    A line goes if a run of ``min_lines`` lines that covers it also stands at
    an earlier place: in a document with a smaller id (nulls first; ties by a
    hash of the text), or higher up in the same one.  With ``min_words``, a
    line of at least so many words is a run by itself; without, a single line
    stays in every copy, however long it is.  Lines end at ``\\n`` and
    are equal if their bytes are (told by 64-bit hashes).  The remaining lines
    are joined by ``\\n``.

    All columns stay; ``line_count``, ``removed_lines``, ``removed_runs`` and
    ``longest_shared`` are added, in place of columns of those names.  A null
    text stays null and has no lines; an empty text has one empty line.  Rows
    equal in id and text are one document.  An empty table stays empty.
    """
    own = docs.drop("line_count", "removed_lines", "removed_runs", "longest_shared")
    keyed = own.withColumns({
        "__doc": F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63)).cast("long")),
        "__content": F.coalesce(F.xxhash64(F.col(text_col)), F.lit(0).cast("long"))})
    slim = keyed.filter(F.col(text_col).isNotNull()).select(
        F.col("__doc").alias("doc"), F.col("__content").alias("content"), F.col(text_col).alias("text"))
    runs = materialize(repeated_runs(slim, min_lines, min_words).groupBy(*_KEY).agg(
        F.collect_list(F.struct("start", "end")).alias("__runs"), F.max("longest").cast("long").alias("longest_shared")), "lines-runs")
    runs = runs.withColumnsRenamed({"doc": "__doc", "content": "__content"})
    joined = join_small_side(keyed, runs, ["__doc", "__content"], "left")
    lines, cuts = F.split(F.col(text_col), "\n", -1), F.coalesce(F.col("__runs"), F.expr("array()").cast("array<struct<start:int,end:int>>"))

    def stays(line: Column, i: Column) -> Column:
        return ~F.exists("__runs", lambda r: (i >= r["start"]) & (i < r["end"]))

    out = joined.withColumns({
        text_col: F.when(F.col("__runs").isNull(), F.col(text_col)).otherwise(F.array_join(F.filter(lines, stays), "\n")),
        "line_count": F.when(F.col(text_col).isNull(), F.lit(0)).otherwise(F.size(lines)).cast("long"),
        "removed_lines": F.aggregate(cuts, F.lit(0).cast("long"), lambda a, r: a + (r["end"] - r["start"])),
        "removed_runs": F.size(cuts).cast("long"),
        "longest_shared": F.coalesce("longest_shared", F.lit(0).cast("long"))})
    return out.select(*[F.col(f"`{c}`") for c in own.columns], "line_count", "removed_lines", "removed_runs", "longest_shared")
