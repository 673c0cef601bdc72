"""CSV sources.

* Reading **by name**: every column is STRING and columns are picked by header
  name, so a wider or reordered file cannot shift values.  A user schema binds
  by *position* and is only used where the file layout is fixed (the ratings
  files).
* Rows with more or fewer cells than the header are kept, on request with
  their text in ``MALFORMED``; cleaning then rejects them.
* Doubled quotes and line breaks inside cells are read the way the CSV writer
  of the source system produced them.  Such files are split too: whether a line
  begins inside a cell is found by a scan over the byte ranges' quote states
  (:mod:`marquee.sources.records`), and whole records are parsed.
* Files whose headers may differ are grouped by header line (read from the
  first bytes of each file) and each group is read in one scan; the groups
  are combined with ``unionByName``.  A single read would take one file's
  header for all of them and silently swap values.
"""

from __future__ import annotations

import csv
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from marquee.operators.dedup import union_by_name
from marquee.operators.joins import join_small_side
from marquee.sources.records import identity, joined_records

# Text a CSV cell may hold for "missing" (pandas' default set).
NULL_TOKENS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
               "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
               "n/a", "nan", "null")

# Holds the text of a row whose number of cells is not the header's, else NULL.
MALFORMED = "__malformed"
# Where a row was read: its file, and where the byte range begins in which it does.
FILE, BLOCK = "__file", "__block"
ORIGIN = [FILE, BLOCK]


def _hadoop(spark: SparkSession):
    return spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()


def data_files(spark: SparkSession, paths: list[str] | str) -> list[tuple[str, int]]:
    """(name, size) of the files behind paths, globs and folders at any depth
    (hidden ``_``/``.`` files and folders skipped), by name."""
    jvm, conf = _hadoop(spark)
    out = {}
    for path in [paths] if isinstance(paths, str) else paths:
        p = jvm.org.apache.hadoop.fs.Path(path)
        fs = p.getFileSystem(conf)
        for st in fs.globStatus(p) or []:
            top = st.getPath().toString()
            files = fs.listFiles(st.getPath(), True)
            while files.hasNext():
                status = files.next()
                f = status.getPath().toString()
                below = f[len(top):].split("/") if f != top else [f.rsplit("/", 1)[-1]]
                if not any(part.startswith(("_", ".")) for part in below if part):
                    out[f] = status.getLen()
    return sorted(out.items())


def list_data_files(spark: SparkSession, paths: list[str] | str) -> list[str]:
    """The names of :func:`data_files`."""
    return [name for name, _ in data_files(spark, paths)]


def header_line(spark: SparkSession, path: str) -> str:
    """First line of a (possibly compressed) text file, read by the driver:
    a few bytes per file, never the data.  A carriage return at its end stays."""
    jvm, conf = _hadoop(spark)
    p = jvm.org.apache.hadoop.fs.Path(path)
    stream = p.getFileSystem(conf).open(p)
    try:
        codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(p)
        raw = codec.createInputStream(stream) if codec is not None else stream
        lines = jvm.java.util.Scanner(raw, "UTF-8").useDelimiter("\n")
        return (lines.next() if lines.hasNext() else "").lstrip("\ufeff")
    finally:
        stream.close()


def files_by_header(spark: SparkSession, paths: list[str] | str,
                    threads: int = 16) -> dict[str, list[str]]:
    """Group files by their header line, so each group can be read in one
    scan and groups are aligned by column name.  Headers are fetched by a
    few driver threads (one small read per file, latency-bound on object
    stores), never by scanning the data."""
    files = list_data_files(spark, paths)
    with ThreadPoolExecutor(max_workers=max(1, min(threads, len(files)))) as pool:
        headers = list(pool.map(lambda f: header_line(spark, f), files))
    groups: dict[str, list[str]] = {}
    for f, h in zip(files, headers):
        groups.setdefault(h, []).append(f)
    return groups


def null_tokens_to_null(df: DataFrame, columns: list[str] | None = None,
                        tokens: tuple[str, ...] = NULL_TOKENS) -> DataFrame:
    """Turn every missing-value token into NULL (Spark's ``nullValue`` takes one)."""
    cols = columns or df.columns
    return df.select(*[
        (F.when(F.col(f"`{c}`").isin(list(tokens)), F.lit(None).cast("string"))
         .otherwise(F.col(f"`{c}`")).alias(c)) if c in cols else F.col(f"`{c}`")
        for c in df.columns])


# A quoted cell up to the quote that closes it; a cell from its start; a line that ends outside of a quoted cell, if it
# begins at a cell's start and inside a quoted cell.  Nothing is given back, so a long line takes no stack.
_QUOTED = r'"(?:[^"]++|"")*+"'
_CELL = rf'(?:{_QUOTED}|(?!"))[^,]*+'
_CLOSED = (rf"^(?:{_CELL},)*+{_CELL}\z", rf'^(?:[^"]++|"")*+"[^,]*+(?:,{_CELL})*+\z')


def _quote_code(line: Column) -> Column:
    """A line's code for :func:`records.joined_records`: state 1 is inside a
    quoted cell.

    A quote at a cell's start opens it; in a quoted cell two are one of its
    characters, a single one closes it; other quotes are characters.  What
    follows a closing quote belongs to the cell up to the next comma."""
    code = sum((~line.rlike(closed)).cast("int") * 2 ** start for start, closed in enumerate(_CLOSED))
    return F.when(line.contains('"'), code).otherwise(F.lit(identity(2)))


def with_paths(spark: SparkSession, df: DataFrame, files: list[str]) -> DataFrame:
    """``df``, whose ``file`` is the hash of a file's path, with that path as
    ``FILE``."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    names = spark.createDataFrame([(path(f).toUri().toString(), f) for f in files], f"uri string, {FILE} string")
    return join_small_side(df, names.select(F.xxhash64("uri").alias("file"), FILE), "file").drop("file")


def _read_group(spark: SparkSession, header: str, files: list[str], multiline: bool, malformed: bool,
                origin: bool = False) -> tuple[DataFrame, int]:
    """Files of one header line, read in one scan, and the number of its tasks.  As in the built-in reader,
    the line break behind the header is the file's: where that is CR LF, one
    inside a cell reads as LF.  Files with CR alone are not split."""
    line, windows = header.rstrip("\r"), header.endswith("\r")
    mac, line = "\r" in line, line.split("\r")[0]
    names = next(csv.reader([line]))
    if len(set(names)) < len(names):
        raise ValueError(f"{files[0]}: the header repeats a column")
    schema = StructType([StructField(n, StringType()) for n in [*names, MALFORMED]])
    # without pruning, cells beyond the chosen columns are looked at: needed to tell wrong cell counts
    options = {"multiLine": str(multiline).lower(), "quote": '"', "escape": '"', "mode": "PERMISSIVE",
               "columnNameOfCorruptRecord": MALFORMED, "columnPruning": str(not malformed).lower(),
               "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    if not multiline or mac:
        df = spark.read.schema(schema).options(header=True, **options).csv(files)
        tasks = df.rdd.getNumPartitions()
        return (_with_origin(df) if origin else df), tasks
    records, ranges = joined_records(spark, files, "\n", 2, _quote_code)
    records = records.filter(~F.col("first"))
    text = F.regexp_replace("value", r"\r$", "")
    ddl = ", ".join(f"`{f.name.replace('`', '``')}` STRING" for f in schema.fields)
    kept = []
    if origin:
        records, kept = with_paths(spark, records.withColumnRenamed("block", BLOCK), files), ORIGIN
    rows = records.select(text.alias("value"), *kept).filter("value <> ''") \
        .select(F.from_csv("value", ddl, options).alias("r"), *kept).select("r.*", *kept)
    own = [F.col(f"`{n}`") for n in names]
    if windows:
        rows = rows.select(*[F.replace(c, F.lit("\r\n"), F.lit("\n")).alias(n) for c, n in zip(own, names)], MALFORMED, *kept)
    return rows, ranges


def read_csv_text(spark: SparkSession, path: str | list[str], columns: list[str] | None = None,
                  partitions: int | None = None, null_tokens: bool = True,
                  multiline: bool = True, defaults: list[str] | None = None,
                  malformed: bool = False, origin: bool = False) -> DataFrame:
    """CSV files (paths, globs or folders) as STRING columns chosen by header
    name, all files appended (union all).  ``malformed`` adds ``MALFORMED``,
    ``origin`` the columns of ``ORIGIN``.

    Files are grouped by header line: one scan per distinct header, so inputs
    that mix column orders are read right.  A column that a header lacks is
    NULL if it is one of ``defaults`` (cleaning gives it its default), else an
    error.

    Files are split in either case.  With ``multiline`` cells may hold line
    breaks; the files' byte ranges are then scanned once when this is called,
    which ``multiline=False`` saves for files without any.  When the scan
    yields fewer than half the cluster's cores worth of tasks (small files, or
    compressed ones) the rows are spread right after it, unless ``partitions``
    says otherwise.
    """
    groups = {h: f for h, f in files_by_header(spark, path).items() if h.strip("\r")}
    if not groups:
        raise FileNotFoundError(f"no CSV matched {path}")
    frames, tasks = [], 0
    for header, files in sorted(groups.items()):
        df, own_tasks = _read_group(spark, header, files, multiline, malformed, origin)
        tasks += own_tasks
        if columns is not None:
            missing = [c for c in columns if c not in df.columns]
            if set(missing) - set(defaults or ()):
                raise ValueError(f"{files[0]}: header lacks {missing}")
            df = df.withColumns({c: F.lit(None).cast("string") for c in missing}) if missing else df
            df = df.select(*[F.col(f"`{c}`") for c in columns], MALFORMED, *(ORIGIN if origin else []))
        frames.append(df if malformed else df.drop(MALFORMED))
    df = union_by_name(frames)
    if null_tokens:
        df = null_tokens_to_null(df, [c for c in df.columns if c not in (MALFORMED, *ORIGIN)])
    if partitions is None and multiline:
        cores = spark.sparkContext.defaultParallelism
        if tasks * 2 < cores:
            partitions = cores
    return df.repartition(partitions) if partitions else df


def read_csv_union(spark: SparkSession, paths: list[str] | str,
                   columns: list[str] | None = None, partitions: int | None = None,
                   defaults: list[str] | None = None, malformed: bool = False, origin: bool = False) -> DataFrame:
    """``read_csv_text`` for files without line breaks inside cells, which are
    read by many tasks each."""
    return read_csv_text(spark, paths, columns, partitions, multiline=False, defaults=defaults,
                         malformed=malformed, origin=origin)


def _with_origin(df: DataFrame) -> DataFrame:
    """A file scan's rows with ``ORIGIN``."""
    path = F.url_decode(F.replace("_metadata.file_path", F.lit("+"), F.lit("%2B")))
    return df.select("*", path.alias(FILE), F.col("_metadata.file_block_start").alias(BLOCK))


def read_csv_positional(spark: SparkSession, path: str | list[str], ddl: str, origin: bool = False) -> DataFrame:
    """Fixed-layout CSV(s) with a header line, bound by position to ``ddl``;
    ``origin`` adds the columns of ``ORIGIN``.

    Malformed cells become NULL (the row is kept).  Splittable, so a large
    file is read by many tasks.
    """
    df = spark.read.schema(ddl).option("header", True).option("mode", "PERMISSIVE").csv(path)
    return _with_origin(df) if origin else df


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", rows_per_file: int = 0) -> None:
    """Header + UTF-8 CSV, written by every task in parallel (no collect), in
    files of at most ``rows_per_file`` rows (0: one file for each task)."""
    (df.write.mode(mode).option("header", True).option("maxRecordsPerFile", rows_per_file).option("quote", '"')
     .option("escape", '"').option("encoding", "UTF-8")
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
     .csv(path))
