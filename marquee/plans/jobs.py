"""The film jobs, as DataFrame functions.

=====  ==================  =============================================
job    function            work
=====  ==================  =============================================
E1     ``stage_links``     link CSVs by name -> union -> contract -> distinct
E2     ``stage_metadata``  metadata CSV by name -> contract -> distinct
E3     ``stage_ratings``   rating CSVs by position -> group mean
E4     ``clean_feed``      XML feed -> prefix/trim -> renamed columns
E5     ``top_movies``      joins -> ratio -> dense top-k -> distinct
E6     ``run_all``         E1..E5 from files, tables written to a folder
=====  ==================  =============================================

``run_all`` writes tables.  ``top_movies`` runs jobs while it is built (the
ranked input is written once, its bound found, small sides measured); the
other functions only read file headers.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from marquee import contracts as K
from marquee.functions.ratio import guarded_ratio
from marquee.functions.text import clean_feed_title
from marquee.functions.validators import INT_SENTINEL
from marquee.operators.aggregate import mean_rating, mean_state, merged_states, state_means
from marquee.operators.clean import PLACE, REASONS, Cleaned, annotate, apply_contract, split_annotated
from marquee.operators.dedup import distinct_rows
from marquee.operators.joins import join_small_side
from marquee.operators.rank import dense_top_k, dense_top_k_window
from marquee.sources.csv import data_files, read_csv_positional, read_csv_text, read_csv_union, write_csv
from marquee.sources.tables import load_table, replace_tables, write_table
from marquee.session import delete_path, path_exists
from marquee.session import materialize as keep
from marquee.sources.xml import computed_once, feed_records, parse_records, parsed_record, read_xml_feed, simple_child

TOP_K = 1000
TABLES = ("movie_links", "movies_metadata", "movie_ratings", "wiki_feed", "top_movies")


def raw_links(spark: SparkSession, paths: list[str] | str) -> DataFrame:
    return read_csv_union(spark, paths, K.MOVIE_LINKS.sources, defaults=K.MOVIE_LINKS.defaulted, malformed=True, origin=True)


def raw_metadata(spark: SparkSession, path: str | list[str], partitions: int | None = None) -> DataFrame:
    return read_csv_text(spark, path, K.MOVIES_METADATA.sources, partitions,
                         defaults=K.MOVIES_METADATA.defaulted, malformed=True, origin=True)


def stage_links(spark: SparkSession, paths: list[str] | str) -> Cleaned:
    """Id-link files of possibly different column order, aligned by name."""
    return apply_contract(raw_links(spark, paths), K.MOVIE_LINKS)


def stage_metadata(spark: SparkSession, path: str | list[str], partitions: int | None = None) -> Cleaned:
    """Movies metadata, nine contract columns chosen by header name; files
    may differ in their column order."""
    return apply_contract(raw_metadata(spark, path, partitions), K.MOVIES_METADATA)


def ratings_mean(ratings: DataFrame) -> DataFrame:
    """E3 core: mean rating per film, one decimal."""
    return mean_rating(ratings.select("movie_id", "rating"), "movie_id", "rating", 1, "rating")


def stage_rating_rows(spark: SparkSession, path_glob: str | list[str]) -> Cleaned:
    """Rows of all rating files (a glob: every matching file counts, duplicates
    too).  Rows without a film id that fits the table are rejects; a rating
    that is no number is NULL and its row counts."""
    return apply_contract(read_csv_positional(spark, path_glob, K.RATINGS_FILE_DDL, origin=True), K.RATING_ROWS, distinct=False)


def stage_ratings(spark: SparkSession, path_glob: str | list[str]) -> DataFrame:
    """The mean of all valid rating rows of each film."""
    return ratings_mean(stage_rating_rows(spark, path_glob).valid)


def fold_ratings(spark: SparkSession, state_path: str, paths: str | list[str]) -> DataFrame:
    """E3 kept up to date: mean ratings of all rating files folded in so far.

    ``state_path`` holds, for each film, the exact total and the number of its
    ratings, and the names and sizes of the files that are counted.  Only files
    of ``paths`` that are not among those are read; their state is merged into
    the old one, and both tables are replaced at once, so a failed run counts
    nothing and a repeated one nothing twice.  A counted file that changed its
    size is an error: what it added cannot be taken back.
    """
    path = state_path.rstrip("/")
    files = spark.createDataFrame(data_files(spark, paths), "name string, size long")
    held = path_exists(spark, path)
    if held:
        counted = spark.read.parquet(f"{path}/files")
        changed = files.join(counted.withColumnRenamed("size", "was"), "name").filter("size <> was").limit(1).collect()
        if changed:
            raise ValueError(f"{changed[0]['name']} was counted with {changed[0]['was']} bytes and now has {changed[0]['size']}")
        files = files.join(counted, "name", "left_anti")
    new = [r["name"] for r in files.collect()]  # names of files given by this call
    if new or not held:
        rows = stage_rating_rows(spark, new).valid if new else \
            spark.createDataFrame([], "movie_id int, rating double")
        state = mean_state(rows)
        if held:
            state = merged_states(spark.read.parquet(f"{path}/state"), state)
            files = counted.unionByName(files)
        replace_tables(spark, path, {"state": state, "files": files})
    return state_means(spark.read.parquet(f"{path}/state")).select("movie_id", "rating")


def clean_feed(feed: DataFrame) -> DataFrame:
    """(url, title, abstract) -> (title, wiki_url, wiki_abstract)."""
    return feed.select(
        clean_feed_title(F.col("title")).alias("title"),
        F.trim(F.col("url")).alias("wiki_url"),
        F.trim(F.col("abstract")).alias("wiki_abstract"))


def unreadable(feed: DataFrame) -> Column:
    """Whether nothing of a record could be read."""
    return F.col("title").isNull() & F.col("url").isNull() & F.col("abstract").isNull()


def read_clean_feed(spark: SparkSession, path: str, split: bool = True) -> DataFrame:
    feed = read_xml_feed(spark, path, split=split)
    return clean_feed(feed.filter(~unreadable(feed)))


def feed_rejects(spark: SparkSession, path: str) -> DataFrame:
    """Text, file and reason of the feed's unreadable records."""
    feed = parse_records(feed_records(spark, path, origin=True), raw_col="raw_record")
    return _feed_rejects(feed.filter(unreadable(feed)))


def _feed_rejects(unread: DataFrame) -> DataFrame:
    return unread.select("raw_record", *[F.col(c).alias(name) for c, name in PLACE.items()],
                         F.array(F.lit("record:unreadable")).alias(REASONS))


def linked_movies(links: DataFrame, metadata: DataFrame, ratings: DataFrame) -> DataFrame:
    """links x metadata on (tmdb_id, imdb_id) x ratings on movie_id, title trimmed.

    Keys are already sentinel-filled, so two missing ids match each other,
    exactly as the source database did.
    """
    m = metadata.select("tmdb_id", "imdb_id", F.trim("title").alias("title"), "budget",
                        "release_date", "revenue", "production_companies")
    return (links.select("movie_id", "imdb_id", "tmdb_id")
            .join(m, ["tmdb_id", "imdb_id"], "inner")
            .join(ratings.select("movie_id", "rating"), "movie_id", "inner")
            .select("movie_id", "imdb_id", "title", "budget", "release_date", "revenue",
                    "production_companies", "rating"))


def movie_ratios(movies: DataFrame, ratio_mode: str = "decimal",
                 numerator: str = "budget", denominator: str = "revenue") -> DataFrame:
    """Add ``year`` and ``ratio`` (by default budget per unit of revenue, so
    the "top" films are the weakest returns; swap the columns for the
    strongest)."""
    return movies.select(
        "title", "budget", F.year("release_date").alias("year"), "revenue", "rating",
        guarded_ratio(F.col(numerator), F.col(denominator), ratio_mode).alias("ratio"),
        "production_companies")


class ParsedFeed:
    """A feed whose entries are rows (title, wiki_url, wiki_abstract)."""

    def __init__(self, entries: DataFrame):
        self.rows = entries.select("title", "wiki_url", "wiki_abstract")

    def titles(self) -> DataFrame:
        return self.rows.select("title").distinct()

    def entries(self, titles: DataFrame, measure: bool) -> DataFrame:
        """Entries of some titles."""
        if measure:
            return join_small_side(self.rows, titles, "title", "left_semi")
        return self.rows.join(titles, "title", "left_semi")


class RawFeed:
    """A feed file, of which only entries of wanted titles are parsed.

    A record's title is taken from its text where that is plain; records whose
    title has entities, sections or attributes are parsed for it.  ``unread``
    are titles of which no record could be parsed: found when they are wanted
    (:func:`top_movies`).
    """

    def __init__(self, records: DataFrame, unread: DataFrame | None = None):
        self.records, self.unread = records, unread

    @classmethod
    def of(cls, spark: SparkSession, path: str) -> RawFeed:
        frag = F.col("frag")
        plain = computed_once(feed_records(spark, path), plain=simple_child(frag, "title"))
        title = F.coalesce("plain", parsed_record(F.when(F.col("plain").isNull(), frag))["title"])
        return cls(computed_once(plain, title=clean_feed_title(title)).select("frag", "title"))

    def without(self, titles: DataFrame) -> RawFeed:
        return RawFeed(self.records, titles if self.unread is None else self.unread.unionByName(titles))

    def titles(self) -> DataFrame:
        found = self.records.select("title").distinct()
        return found if self.unread is None else found.join(self.unread, "title", "left_anti")

    def wanted(self, titles: DataFrame) -> DataFrame:
        """Records that may be entries of some titles, unparsed."""
        return join_small_side(self.records, titles.select("title"), "title", "left_semi").select("frag")

    def entries(self, titles: DataFrame, measure: bool = True) -> DataFrame:
        return join_small_side(clean_feed(parse_records(self.wanted(titles))), titles, "title", "left_semi")


def top_movies(movies: DataFrame, feed: DataFrame | RawFeed, k: int = TOP_K,
               ratio_mode: str = "decimal", materialize: bool = True,
               numerator: str = "budget", denominator: str = "revenue") -> DataFrame:
    """E5: films matched to the feed by title whose ratio is among the ``k``
    highest distinct ratios, one row per (film, feed entry), distinct.

    Rank first, fan out last: a film takes part in the ranking iff its title
    has at least one feed entry (semi-join on the distinct feed titles), and
    ``dense_top_k`` does not depend on how many entries a title has.  So the
    many-to-many title join runs only for the winners, not the whole table.
    Of a ``RawFeed`` only the winners' entries are parsed.
    """
    feed = feed if isinstance(feed, RawFeed) else ParsedFeed(feed)
    candidates = movie_ratios(movies.join(feed.titles(), "title", "left_semi"), ratio_mode,
                              numerator, denominator)
    winners = dense_top_k(candidates, "ratio", k, materialize_input=materialize)
    winners = distinct_rows(winners.select(
        "title", F.col("budget").cast("double").alias("budget"),
        F.coalesce(F.col("year"), F.lit(INT_SENTINEL)).cast("int").alias("year"),
        F.col("revenue").cast("double").alias("revenue"), "rating",
        F.col("ratio").cast("double").alias("ratio"), "production_companies"))
    # both sides without repeated rows, so the join has none: abstracts are
    # no part of a distinct over the fanned-out rows
    if materialize:
        winners = keep(winners, "top-winners")
        titles = keep(winners.select("title").distinct(), "top-titles")
        entries = distinct_rows(feed.entries(titles, True))
        if isinstance(feed, RawFeed):
            entries = keep(entries, "top-entries")
            lost = keep(titles.join(entries.select("title"), "title", "left_anti"), "top-unread")
            if not lost.isEmpty():  # titles of unreadable records only: rank without them
                return top_movies(movies, feed.without(lost), k, ratio_mode, materialize, numerator, denominator)
        out = join_small_side(entries, winners, "title", "inner")
    else:
        out = winners.join(distinct_rows(feed.entries(winners.select("title").distinct(), False)), "title", "inner")
    return out.select("title", "budget", "year", "revenue", "rating", "ratio", "production_companies",
                      "wiki_url", "wiki_abstract")


def top_movies_window(movies: DataFrame, feed: DataFrame, k: int = TOP_K,
                      ratio_mode: str = "decimal") -> DataFrame:
    """E5 as first written (join everything, global window).  Test oracle only:
    its window sends every row through one task."""
    joined = movies.join(feed.select("title", "wiki_url", "wiki_abstract"), "title")
    r = joined.select(
        "title", "budget", F.year("release_date").alias("year"), "revenue", "rating",
        guarded_ratio(F.col("budget"), F.col("revenue"), ratio_mode).alias("ratio"),
        "production_companies", "wiki_url", "wiki_abstract")
    top = dense_top_k_window(r, "ratio", k)
    return top.select(
        "title", F.col("budget").cast("double").alias("budget"),
        F.coalesce(F.col("year"), F.lit(INT_SENTINEL)).cast("int").alias("year"),
        F.col("revenue").cast("double").alias("revenue"), "rating",
        F.col("ratio").cast("double").alias("ratio"), "production_companies",
        "wiki_url", "wiki_abstract").dropDuplicates()


@dataclass
class FilmTables:
    links: DataFrame
    metadata: DataFrame
    ratings: DataFrame
    feed: DataFrame
    top: DataFrame
    link_rejects: DataFrame
    metadata_rejects: DataFrame
    rating_rejects: DataFrame
    feed_rejects: DataFrame


def run_all(spark: SparkSession, out_dir: str, metadata_csv: str, link_csvs: list[str],
            ratings_glob: str, feed_xml: str, k: int = TOP_K,
            ratio_mode: str = "decimal", enforce_constraints: bool = False,
            numerator: str = "budget", denominator: str = "revenue",
            csv_dir: str | None = None, tables: tuple[str, ...] = TABLES) -> FilmTables:
    """Stage every table, then build ``top_movies`` from the written tables.

    Every CSV input is parsed once: the annotated rows (typed values, reasons,
    raw text of rejects) are written first, valid rows and rejects apart, and
    the table and its quarantine each read their part; that copy is deleted at
    the end.  The feed, the widest input, is written to its table only, while
    its unreadable records are counted; it is read again for them if there are
    any.  Later steps read written tables, so a lost executor never re-runs the
    parsing and the lineage stays short.
    ``csv_dir`` also exports every table as CSV.  Of a list of ``tables`` only
    those, with their quarantines, are written; ``top_movies`` needs the others
    to be there or listed.

    With ``enforce_constraints`` every table is loaded all-or-nothing
    (``sources.tables.load_table``): a table whose keys or checks would be
    violated is not written and ``ConstraintError`` is raised.
    """
    out = out_dir.rstrip("/")

    def publish(df: DataFrame, path: str, contract: K.TableContract) -> None:
        if enforce_constraints:
            load_table(spark, df, path, contract, mode="overwrite")
        else:
            write_table(df, path, contract)

    def halves(name: str, rows: DataFrame, is_reject: Column) -> tuple[DataFrame, DataFrame]:
        """Valid rows and rejects of an input that is parsed once: both are
        written, apart, with the raw columns of rejects only."""
        own = (*PLACE, *PLACE.values())
        raw = {c: F.when(F.col("is_reject") == 1, F.col(c)) for c in rows.columns if c.startswith("raw_") or c in own}
        path = f"{out}/_annotated/{name}"
        rows.withColumn("is_reject", is_reject.cast("int")).withColumns(raw).write.mode("overwrite") \
            .partitionBy("is_reject").parquet(path)
        schema = StructType([*rows.schema.fields, StructField("is_reject", IntegerType())])
        kept = spark.read.schema(schema).parquet(path)  # a schema, as an input may be without rows
        return kept.filter("is_reject = 0"), kept.filter("is_reject = 1")

    def quarantine(rejects: DataFrame, name: str) -> None:
        rejects.write.mode("overwrite").parquet(f"{out}/quarantine/{name}")

    for name, read, contract in (("movie_links", lambda: raw_links(spark, link_csvs), K.MOVIE_LINKS),
                                 ("movies_metadata", lambda: raw_metadata(spark, metadata_csv), K.MOVIES_METADATA)):
        if name not in tables:
            continue
        good, bad = halves(name, annotate(read(), contract), F.size(REASONS) > 0)
        publish(split_annotated(good, contract).valid, f"{out}/{name}", contract)
        quarantine(split_annotated(bad, contract).rejects, name)
    if "movie_ratings" in tables:
        rows = stage_rating_rows(spark, ratings_glob).annotated
        good, bad = halves("movie_ratings", rows, F.size(REASONS) > 0)
        publish(ratings_mean(split_annotated(good, K.RATING_ROWS, distinct=False).valid), f"{out}/movie_ratings", K.MOVIE_RATINGS)
        quarantine(split_annotated(bad, K.RATING_ROWS, distinct=False).rejects, "movie_ratings")
    if "wiki_feed" in tables:
        feed = parse_records(feed_records(spark, feed_xml, origin=True), raw_col="raw_record")
        seen = Observation("wiki_feed")
        counted = feed.observe(seen, F.count_if(unreadable(feed)).alias("unreadable"))
        write_table(clean_feed(counted.filter(~unreadable(feed))), f"{out}/wiki_feed")
        quarantine(_feed_rejects(feed.filter(unreadable(feed) if seen.get["unreadable"] else F.lit(False))), "wiki_feed")
    delete_path(spark, f"{out}/_annotated")
    if "top_movies" in tables:
        t = read_tables(spark, out)
        movies = linked_movies(t.links, t.metadata, t.ratings)
        publish(top_movies(movies, t.feed, k, ratio_mode, numerator=numerator,
                           denominator=denominator), f"{out}/top_movies", K.TOP_MOVIES)
    for name in tables if csv_dir else ():
        write_csv(spark.read.parquet(f"{out}/{name}"), f"{csv_dir.rstrip('/')}/{name}")
    return read_tables(spark, out)


def read_tables(spark: SparkSession, out_dir: str) -> FilmTables:
    """The tables written by ``run_all`` (the cleaned feed as Parquet)."""
    out = out_dir.rstrip("/")

    def rd(name):
        path = f"{out}/{name}"
        return spark.read.parquet(path) if path_exists(spark, path) else None
    return FilmTables(rd("movie_links"), rd("movies_metadata"), rd("movie_ratings"), rd("wiki_feed"),
                      rd("top_movies"), rd("quarantine/movie_links"),
                      rd("quarantine/movies_metadata"), rd("quarantine/movie_ratings"),
                      rd("quarantine/wiki_feed"))

