"""Film-shaped raw inputs derived from the driver tables.

The driver ships TPC-H-like tables, not movie files.  This module derives,
with Spark, raw inputs that look like the film sources — text columns, Python
literal lists, dirty values — so the film jobs run unchanged on data whose
size grows with the driver tables:

=====================  =====================================================
film input             derived from
=====================  =====================================================
movies metadata CSV    one film per ``orders`` row; title = customer name,
                       budget = ``o_totalprice``, revenue = sum of the
                       order's ``l_extendedprice``, release = ``o_orderdate``,
                       genres from the order priority/status, production
                       companies from the customer's nation and segment
id-link CSVs           ``orders`` keys (full file) and the urgent orders
                       again with columns in another order (small file)
ratings CSVs           every ``lineitem`` row is one rating (``l_quantity``)
                       of film ``l_orderkey``; returned items again (small)
encyclopedia XML       one ``<doc>`` per ``documents`` row; its title names
                       customer ``doc_id div 2`` (two entries per title);
                       the abstract is the whole document text
=====================  =====================================================

Dirty values are placed deterministically by key (``DIRT`` below); the same
table drives the DuckDB oracle, so both sides agree on every injected defect.
All rows of every table flow through; nothing is sampled or capped.
"""

from __future__ import annotations

import threading
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.session import fingerprint, mark_done, path_exists, staging_dir
from marquee.sources.csv import write_csv
from marquee.sources.tables import read_table
from marquee.sources.xml import write_xml_feed

# Key moduli at which a defect is injected (row key % modulus == 0).
DIRT = {
    "id_null": 101, "id_date": 103, "id_overflow": 211,
    "imdb_bare": 107,
    "genres_null": 109, "genres_object": 113,
    "original_title_null": 223, "title_padded": 127,
    "budget_exponent": 131, "budget_null": 137, "budget_negative": 139, "budget_trailing_dot": 227, "budget_huge": 233,
    "date_padded": 149, "date_unpadded": 151,
    "revenue_zero": 157, "revenue_null": 163,
    "companies_empty": 167, "companies_none": 173, "companies_junk": 179,
    "companies_apostrophe": 181, "companies_escape": 191, "companies_trailing": 193, "companies_slash": 197, "companies_surrogate": 199,
    "genres_extra_key": 83, "genres_quoted_id": 89, "genres_float_id": 79, "genres_long_id": 73, "genres_overflow": 241,
    "link_imdb_float": 53, "link_tmdb_null": 59, "link_tmdb_text": 61,
    "rating_text": 97, "rating_id_long": 71,
    "feed_prefix_space": 7, "feed_title_padded": 5,
}

# So many signs before a number overflow the stack of Python's parser.
PARSER_OVERFLOW = 7000

# Added to an id, it does not fit an INT any more.
LONG_ID = 3_000_000_000

FEED_URL = "https://en.wikipedia.example/wiki/Doc_"
# Documents per feed title: doc d describes customer d div FEED_DOCS_PER_TITLE,
# so every matched film fans out to several feed entries.
FEED_DOCS_PER_TITLE = 2


def _hit(key: Column, name: str) -> Column:
    return (key % F.lit(DIRT[name])) == 0


def _s(c: Column) -> Column:
    return c.cast("string")


def raw_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Movies-metadata-shaped text rows, one per order (plus an unused column)."""
    o = read_table(spark, sf_dir, "orders")
    c = read_table(spark, sf_dir, "customer")
    n = read_table(spark, sf_dir, "nation")
    li = read_table(spark, sf_dir, "lineitem")
    rev = li.groupBy("l_orderkey").agg(
        F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).alias("rev"))
    base = (o.join(c, o.o_custkey == c.c_custkey)
            .join(n, c.c_nationkey == n.n_nationkey)
            .join(rev, o.o_orderkey == rev.l_orderkey, "left"))
    k = F.col("o_orderkey")
    pr = F.col("o_orderpriority")
    genres = F.concat(F.lit("[{'id': "), F.substring(pr, 1, 1), F.lit(", 'name': '"),
                      F.substring_index(pr, "-", -1), F.lit("'}, {'id': 10, 'name': '"),
                      F.col("o_orderstatus"), F.lit("'}]"))
    nk, nn, seg = _s(F.col("n_nationkey")), F.col("n_name"), F.col("c_mktsegment")
    companies = (
        F.when(_hit(k, "companies_empty"), F.lit("[]"))
        .when(_hit(k, "companies_none"), F.concat(F.lit("[{'name': None, 'id': "), nk, F.lit("}]")))
        .when(_hit(k, "companies_junk"), F.lit("junk"))
        .when(_hit(k, "companies_trailing"), F.lit("[{'name': 'A', 'id': 1}] and more"))
        .when(_hit(k, "companies_slash"), F.lit("[{'name': 'a\\/b', 'id': 1}]"))
        .when(_hit(k, "companies_surrogate"), F.lit("[{'name': '\\ud800', 'id': 1}]"))
        .when(_hit(k, "companies_apostrophe"),
              F.concat(F.lit("[{'name': \""), nn, F.lit("'s Films\", 'id': "), nk, F.lit("}]")))
        .when(_hit(k, "companies_escape"),
              F.concat(F.lit("[{'name': 'caf\\xe9 "), nn, F.lit("', 'id': "), nk, F.lit("}]")))
        .otherwise(F.concat(F.lit("[{'name': '"), nn, F.lit("', 'id': "), nk,
                            F.lit("}, {'name': '"), seg, F.lit("', 'id': 100}]"))))
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    budget = _s(F.col("o_totalprice").cast("decimal(18,2)"))
    return base.select(
        F.lit("False").alias("adult"),
        F.when(_hit(k, "id_null"), F.lit(None).cast("string"))
         .when(_hit(k, "id_date"), F.lit("1997-08-20"))
         .when(_hit(k, "id_overflow"), F.lit("99999999999"))
         .otherwise(_s(k)).alias("id"),
        F.when(_hit(k, "imdb_bare"), F.lit("tt"))
         .otherwise(F.format_string("tt%07d", F.col("o_custkey"))).alias("imdb_id"),
        F.when(_hit(k, "genres_null"), F.lit(None).cast("string"))
         .when(_hit(k, "genres_object"), F.lit("{}"))
         .when(_hit(k, "genres_extra_key"), F.lit("[{'id': 1, 'name': 'URGENT', 'note': None}]"))
         .when(_hit(k, "genres_quoted_id"), F.lit("[{'id': '1', 'name': 'URGENT'}]"))
         .when(_hit(k, "genres_float_id"), F.lit("[{'id': 1.5, 'name': 'URGENT'}]"))
         .when(_hit(k, "genres_long_id"), F.lit("[{'id': 12345678901234567890, 'name': 'URGENT'}]"))
         .when(_hit(k, "genres_overflow"), F.concat(F.lit("["), F.repeat(F.lit("-"), F.lit(PARSER_OVERFLOW)), F.lit("1]")))
         .otherwise(genres).alias("genres"),
        F.when(_hit(k, "original_title_null"), F.lit(None).cast("string"))
         .otherwise(F.col("c_name")).alias("original_title"),
        F.when(_hit(k, "title_padded"), F.concat(F.lit(" "), F.col("c_name"), F.lit("  ")))
         .otherwise(F.col("c_name")).alias("title"),
        F.when(_hit(k, "budget_exponent"), F.lit("1e6"))
         .when(_hit(k, "budget_null"), F.lit(None).cast("string"))
         .when(_hit(k, "budget_huge"), F.lit("1000000000000000000000"))
         .when(_hit(k, "budget_negative"), F.lit("-5"))
         .when(_hit(k, "budget_trailing_dot"), F.lit("1."))
         .otherwise(budget).alias("budget"),
        F.when(_hit(k, "date_padded"), F.concat(F.lit(" "), day))
         .when(_hit(k, "date_unpadded"), F.date_format("o_orderdate", "yyyy-M-d"))
         .otherwise(day).alias("release_date"),
        F.when(_hit(k, "revenue_zero"), F.lit("0"))
         .when(_hit(k, "revenue_null"), F.lit(None).cast("string"))
         .otherwise(_s(F.col("rev"))).alias("revenue"),
        companies.alias("production_companies"),
        _s(k).alias("order_key"),
    )


def raw_links(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(full, small) id-link files; the small one repeats the urgent orders
    with its columns in a different order."""
    o = read_table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    cols = dict(
        movieId=_s(k),
        imdbId=F.when(_hit(k, "link_imdb_float"), F.concat(_s(F.col("o_custkey")), F.lit(".0")))
               .otherwise(_s(F.col("o_custkey"))),
        tmdbId=F.when(_hit(k, "link_tmdb_null"), F.lit(None).cast("string"))
               .when(_hit(k, "link_tmdb_text"), F.lit("x")).otherwise(_s(k)),
    )
    full = o.select(*[v.alias(n) for n, v in cols.items()])
    small = (o.filter(F.col("o_orderpriority") == "1-URGENT")
             .select(cols["tmdbId"].alias("tmdbId"), cols["movieId"].alias("movieId"),
                     cols["imdbId"].alias("imdbId")))
    return full, small


def raw_ratings(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(full, small) rating files: userId, movieId, rating, timestamp."""
    li = read_table(spark, sf_dir, "lineitem")
    key = F.col("l_orderkey") + F.col("l_linenumber")
    rating = F.when(_hit(key, "rating_text"), F.lit("n/a")).otherwise(_s(F.col("l_quantity")))
    movie = F.when(_hit(key, "rating_id_long"), F.col("l_orderkey") + F.lit(LONG_ID)).otherwise(F.col("l_orderkey"))
    cols = [_s(F.col("l_suppkey")).alias("userId"), _s(movie).alias("movieId"),
            rating.alias("rating"), _s(F.unix_timestamp("l_shipdate")).alias("timestamp")]
    full = li.select(*cols)
    small = li.filter(F.col("l_returnflag") == "R").select(*cols)
    return full, small


def raw_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encyclopedia-feed rows (title, url, abstract), one per document."""
    d = read_table(spark, sf_dir, "documents")
    k = F.col("doc_id")
    name = F.format_string("Customer#%09d", F.expr(f"doc_id div {FEED_DOCS_PER_TITLE}"))
    title = (F.when(_hit(k, "feed_prefix_space"), F.concat(F.lit(" Wikipedia: "), name))
             .when(_hit(k, "feed_title_padded"), F.concat(F.lit("Wikipedia:  "), name, F.lit("   ")))
             .otherwise(F.concat(F.lit("Wikipedia: "), name)))
    return d.select(title.alias("title"), F.concat(F.lit(FEED_URL), _s(k)).alias("url"),
                    F.col("text").alias("abstract"))


# ---- staged files --------------------------------------------------------


class FilmFiles:
    """Paths of the staged film inputs for one driver folder.  Each input is
    written (under the shared checkpoint dir) when its path is first asked for;
    later calls reuse it."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self.base = staging_dir(spark, "film-inputs", key=inputs_key(spark, sf_dir))

    def _staged(self, name: str, write: Callable[[str], None]) -> str:
        path, done = f"{self.base}/{name}", f"{self.base}/_STAGED-{name}"
        with STAGING_LOCK:  # concurrent callers in one driver stage once
            if not path_exists(self.spark, done):
                write(path)
                mark_done(self.spark, done)
        return path

    def _csv(self, name: str, rows: Callable[[], DataFrame]) -> str:
        return self._staged(name, lambda path: write_csv(rows(), path, rows_per_file=ROWS_PER_FILE))

    @property
    def metadata(self) -> str:
        return self._csv("movies_metadata", lambda: raw_metadata(self.spark, self.sf_dir))

    @property
    def links_full(self) -> str:
        return self._csv("links", lambda: raw_links(self.spark, self.sf_dir)[0])

    @property
    def links_small(self) -> str:
        return self._csv("links_small", lambda: raw_links(self.spark, self.sf_dir)[1])

    @property
    def ratings_full(self) -> str:
        return self._csv("ratings", lambda: raw_ratings(self.spark, self.sf_dir)[0])

    @property
    def ratings_small(self) -> str:
        return self._csv("ratings_small", lambda: raw_ratings(self.spark, self.sf_dir)[1])

    @property
    def ratings_glob(self) -> str:
        """Matches both rating folders, which are written."""
        assert self.ratings_full and self.ratings_small
        return f"{self.base}/ratings*"

    @property
    def feed(self) -> str:
        return self._staged("feed_xml", lambda path: write_xml_feed(raw_feed(self.spark, self.sf_dir), path))


INPUT_TABLES = ("orders", "customer", "nation", "lineitem", "documents")

# Real dumps arrive as many files of bounded size.
ROWS_PER_FILE = 1_000_000

STAGING_LOCK = threading.RLock()


def inputs_key(spark: SparkSession, sf_dir: str) -> str:
    """Names what is derived from a driver folder: by its path and its files."""
    base = sf_dir.rstrip("/")
    return f"{base} {fingerprint(spark, [f'{base}/{t}.parquet' for t in INPUT_TABLES])}"


def stage_film_files(spark: SparkSession, sf_dir: str) -> FilmFiles:
    """All film inputs of a driver folder, written."""
    files = FilmFiles(spark, sf_dir)
    assert files.metadata and files.links_full and files.links_small and files.ratings_glob and files.feed
    return files
