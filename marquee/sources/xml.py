"""XML feed source (one row per ``<doc>`` under ``<feed>``).

The built-in ``xml`` source reads a file in one task.  ``read_xml_feed`` with
``split=True`` reads the file as text chunks that end at ``</doc>`` — the
text source splits a file by byte ranges, so a large dump is read by many
tasks.  A ``</doc>`` inside CDATA, a comment or a processing instruction ends
no record: :mod:`marquee.sources.records` finds the state at each chunk's end
and puts such chunks together.  Each record is kept from its ``<doc`` on and
parsed with ``from_xml`` against an explicit schema (no inference scan).
Compressed input (gzip) cannot be split by any reader, so its records are
spread over the cluster before they are parsed.

The split form assumes that rows are not self-closing ``<doc/>``.  Comments
are no content and are taken out before parsing.  A section that is never
closed takes the rest of its file into one record, which cannot be parsed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.sources.csv import BLOCK, ORIGIN, list_data_files, with_paths
from marquee.sources.records import end_states, identity, joined_records

FEED_SCHEMA = "title STRING, url STRING, abstract STRING"
# Values must come back exactly as written: no trimming by the parser.
_XML_OPTIONS = {"ignoreSurroundingSpaces": "false", "mode": "PERMISSIVE"}


# States at the end of a chunk: content, and inside CDATA, a comment, an instruction.
_CONTENT, _CDATA, _COMMENT, _INSTRUCTION = range(4)
# What each mark opens, and what it closes.  Marks that hold another one's characters are marks of their own.
_MARKS = {"<![CDATA[": (_CDATA, None), "]]>": (None, _CDATA), "<!--": (_COMMENT, None), "-->": (None, _COMMENT),
          "<!-->": (_COMMENT, _COMMENT), "<!--->": (_COMMENT, _COMMENT), "<?": (_INSTRUCTION, None),
          "?>": (None, _INSTRUCTION), "<?>": (_INSTRUCTION, _INSTRUCTION)}
_MARK = r"<!\[CDATA\[|\]\]>|<!--->|<!-->|<!--|-->|<\?>|<\?|\?>"
# Sections that are kept (first group) or taken out.
_SECTION = r"(?s)(<!\[CDATA\[.*?\]\]>)|<!--.*?-->|<\?.*?\?>"


def _section_code(chunk: Column) -> Column:
    """A chunk's code for :func:`records.joined_records`: its marks are walked
    through; one opens a section in content only, and closes only its own."""
    def step(state: Column, mark: Column) -> Column:
        opens, closes = F.when(F.lit(False), 0), F.when(F.lit(False), 0)
        for text, (o, c) in _MARKS.items():
            opens = opens.when(mark == text, o) if o is not None else opens
            closes = closes.when(mark == text, c) if c is not None else closes
        return (F.when(state == _CONTENT, F.coalesce(opens, state))
                .when(closes == state, F.lit(_CONTENT)).otherwise(state))

    marks = F.regexp_extract_all(chunk, F.lit(f"({_MARK})"), F.lit(1))
    marked = chunk.contains("<!") | chunk.contains("<?") | chunk.contains("]]>") | chunk.contains("-->") | chunk.contains("?>")
    return F.when(marked, end_states(4, step, marks, F.lit)).otherwise(F.lit(identity(4)))


def computed_once(df: DataFrame, **columns: Column) -> DataFrame:
    """``df`` with further columns.  They come from a generator of one row,
    because a filter on a plain column is moved below it, where what the column
    is made of is computed again for each time that it is named."""
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(name) for name, c in columns.items()]))))


def feed_records(spark: SparkSession, path: str, row_tag: str = "doc", partitions: int | None = None,
                 origin: bool = False) -> DataFrame:
    """The records of a feed as text, unparsed: ``frag``, and with ``origin``
    the columns of ``ORIGIN``."""
    end, files = f"</{row_tag}>", list_data_files(spark, path)
    records, ranges = joined_records(spark, files, end, 4, _section_code)
    kept = ORIGIN if origin else []
    if origin:
        records = with_paths(spark, records.withColumnRenamed("block", BLOCK), files)
    cores = spark.sparkContext.defaultParallelism
    if partitions is None and ranges * 2 < cores:
        partitions = cores
    if partitions:
        records = records.repartition(partitions)
    value = F.col("value")
    whole = F.when(value.contains("<!--") | value.contains("<?"), F.regexp_replace(value, _SECTION, "$1")).otherwise(value)
    body = F.regexp_extract(whole, rf"(?s)<{row_tag}[\s>/].*$", 0)
    return computed_once(records, frag=body).filter(F.col("frag") != "").select(F.concat("frag", F.lit(end)).alias("frag"), *kept)


def simple_child(frag: Column, tag: str) -> Column:
    """The text of a record's child ``tag`` where it can be told without
    parsing: the tag occurs once, without attributes, and its text has no
    entity or tag in it.  Else NULL."""
    text = F.substring_index(F.substring_index(frag, f"<{tag}>", -1), f"</{tag}>", 1)
    once = F.length(frag) - F.length(F.replace(frag, F.lit(f"<{tag}"), F.lit(""))) == len(tag) + 1
    return F.when(once & frag.contains(f"<{tag}>") & frag.contains(f"</{tag}>") & ~text.rlike("[&<]"), text)


def parsed_record(frag: Column, schema: str = FEED_SCHEMA) -> Column:
    """The fields of a record of :func:`feed_records`."""
    return F.from_xml(frag, schema, _XML_OPTIONS)


def parse_records(records: DataFrame, schema: str = FEED_SCHEMA, raw_col: str | None = None) -> DataFrame:
    """Rows of :func:`feed_records`, each parsed once."""
    kept = [c for c in ORIGIN if c in records.columns]
    parsed = records.select("frag", parsed_record(F.col("frag"), schema).alias("r"), *kept)
    return parsed.select("r.*", *([F.col("frag").alias(raw_col)] if raw_col else []), *kept)


def read_xml_feed(spark: SparkSession, path: str, schema: str = FEED_SCHEMA,
                  row_tag: str = "doc", split: bool = True,
                  partitions: int | None = None, raw_col: str | None = None) -> DataFrame:
    """Rows of a feed.  ``raw_col`` names a column for each record's text (split
    form only)."""
    if split:
        return parse_records(feed_records(spark, path, row_tag, partitions), schema, raw_col)
    reader = spark.read.format("xml").option("rowTag", row_tag).schema(schema)
    for k, v in _XML_OPTIONS.items():
        reader = reader.option(k, v)
    df = reader.load(path)
    return df.repartition(partitions) if partitions else df


def write_xml_feed(df: DataFrame, path: str, row_tag: str = "doc", root_tag: str = "feed",
                   mode: str = "overwrite") -> None:
    """Write rows as ``<feed><doc>...</doc></feed>`` files, escaped by the writer."""
    (df.write.mode(mode).format("xml").option("rowTag", row_tag)
     .option("rootTag", root_tag).save(path))
