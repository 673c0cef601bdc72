"""Registered queries: name -> (Spark builder, DuckDB oracle SQL or None).

Every builder takes ``(spark, sf_dir)`` and returns a lazy DataFrame over the
whole driver tables (or files Spark derived from them, see ``standins``).
Output columns carry the same names and types on both sides.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee import contracts as K
from marquee.functions.dates import parse_ymd_date
from marquee.functions.jsoncols import with_json_lists
from marquee.functions.ratio import guarded_ratio
from marquee.operators.aggregate import mean_rating
from marquee.operators.clean import REASONS, reject_rows
from marquee.operators.dedup import distinct_rows
from marquee.operators.explode import explode_json_list
from marquee.operators.joins import join_small_side
from marquee.operators.quality import constraint_violations
from marquee.operators.rank import dense_top_k
from marquee.plans import jobs as J
from marquee.plans import oracle_sql as O
from marquee.plans import reports as R
from marquee.plans import sql_reports
from marquee.plans import standins as S
from marquee.session import mark_done, materialize, path_exists, staging_dir
from marquee.sources.csv import read_csv_text
from marquee.sources.tables import ConstraintError, discard_refused, load_table, read_table, write_table

Builder = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[Builder, str | None]] = {}


def register(name: str, sql: str | None):
    def deco(fn: Builder) -> Builder:
        REGISTRY[name] = (fn, sql)
        return fn
    return deco


# ---- shared pieces ----------------------------------------------------------

def _files(spark: SparkSession, sf_dir: str) -> S.FilmFiles:
    return S.FilmFiles(spark, sf_dir)


def _meta(spark, sf_dir):
    return J.stage_metadata(spark, _files(spark, sf_dir).metadata)


def _links(spark, sf_dir):
    f = _files(spark, sf_dir)
    return J.stage_links(spark, [f.links_full, f.links_small])


def _ratings(spark, sf_dir):
    return J.stage_ratings(spark, _files(spark, sf_dir).ratings_glob)


def _feed(spark, sf_dir):
    return J.read_clean_feed(spark, _files(spark, sf_dir).feed)


def film_tables(spark, sf_dir, *names: str) -> J.FilmTables:
    """E6 run once per driver folder: the staged tables and ``top_movies``,
    written under the shared checkpoint dir; of a list of ``names`` those
    only.  Joins and reports read these written tables, as the analyst queries
    read the loaded database tables."""
    f = _files(spark, sf_dir)
    out = staging_dir(spark, "film-tables", key=S.inputs_key(spark, sf_dir))
    with S.STAGING_LOCK:
        left = tuple(n for n in names or J.TABLES if not path_exists(spark, f"{out}/_DONE-{n}"))
        if left:
            J.run_all(spark, out, metadata_csv=f.metadata if "movies_metadata" in left else "",
                      link_csvs=[f.links_full, f.links_small] if "movie_links" in left else [],
                      ratings_glob=f.ratings_glob if "movie_ratings" in left else "",
                      feed_xml=f.feed if "wiki_feed" in left else "", tables=left)
        for n in left:
            mark_done(spark, f"{out}/_DONE-{n}")
    return J.read_tables(spark, out)


def _feed_table(spark, sf_dir):
    return film_tables(spark, sf_dir, "wiki_feed").feed


def _metadata_table(spark, sf_dir):
    return film_tables(spark, sf_dir, "movies_metadata").metadata


def _movies(spark, sf_dir):
    t = film_tables(spark, sf_dir, "movie_links", "movies_metadata", "movie_ratings")
    return J.linked_movies(t.links, t.metadata, t.ratings)


def _top(spark, sf_dir):
    """The written top_movies table (reports read it)."""
    return film_tables(spark, sf_dir).top


W = O.with_

# ---- flagship: ratings mean + revenue + ratio + dense top-k over the orders --

FLAGSHIP_SQL = """
WITH facts AS (
  SELECT l_orderkey, ROUND(AVG(l_quantity), 1) AS rating,
         CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue
  FROM lineitem GROUP BY l_orderkey
),
films AS (
  SELECT o.o_orderkey AS movie_id, o.o_custkey AS imdb_id, o.o_totalprice AS budget,
         CAST(year(o.o_orderdate) AS INTEGER) AS year, f.revenue, f.rating,
         CASE WHEN f.revenue > 0 THEN o.o_totalprice / f.revenue ELSE -999.999 END AS ratio
  FROM orders o JOIN facts f ON f.l_orderkey = o.o_orderkey
),
ranked AS (SELECT *, DENSE_RANK() OVER (ORDER BY ratio DESC) AS rk FROM films)
SELECT DISTINCT movie_id, imdb_id, budget, year, revenue, rating, ratio
FROM ranked WHERE rk <= 1000
"""


@register("top_ratio_dense_rank", FLAGSHIP_SQL)
def top_ratio_dense_rank(spark: SparkSession, sf_dir: str, k: int = J.TOP_K) -> DataFrame:
    """Per film (order): mean rating and revenue from its lineitems in ONE
    aggregation (one shuffle on the order key), budget from the order, ratio,
    then every film among the k highest distinct ratios."""
    li = read_table(spark, sf_dir, "lineitem")
    facts = li.groupBy("l_orderkey").agg(
        F.round(F.avg("l_quantity"), 1).alias("rating"),
        F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("double").alias("revenue"))
    o = read_table(spark, sf_dir, "orders")
    films = o.join(facts, o.o_orderkey == facts.l_orderkey).select(
        F.col("o_orderkey").alias("movie_id"), F.col("o_custkey").alias("imdb_id"),
        F.col("o_totalprice").alias("budget"), F.year("o_orderdate").alias("year"),
        "revenue", "rating",
        guarded_ratio(F.col("o_totalprice"), F.col("revenue"), "double").alias("ratio"))
    return distinct_rows(dense_top_k(films, "ratio", k, materialize_input=True))


# ---- sources, cleaning, staging (E1-E4) -----------------------------------

@register("hot_film_mean_rating", """
SELECT CASE WHEN l_linenumber <= 2 THEN CAST(-1 AS BIGINT) ELSE l_orderkey END AS movie_id,
       ROUND(AVG(l_quantity), 1) AS rating, COUNT(*) AS num_ratings
FROM lineitem GROUP BY 1
""")
def hot_film_mean_rating(spark, sf_dir):
    """Skew: the first two lines of every order rate one blockbuster (film -1),
    about 29% of all rows on one key.  Partial aggregation turns that key into
    one (sum, count) pair per task before the shuffle."""
    li = read_table(spark, sf_dir, "lineitem").select(
        F.when(F.col("l_linenumber") <= 2, F.lit(-1).cast("bigint"))
         .otherwise(F.col("l_orderkey")).alias("movie_id"),
        F.col("l_quantity").alias("rating"))
    return mean_rating(li, "movie_id", "rating", 1, "rating", count_out="num_ratings")


@register("mean_rating_by_item", """
SELECT l_partkey AS movie_id, ROUND(AVG(l_quantity), 1) AS rating FROM lineitem GROUP BY l_partkey
""")
def mean_rating_by_item(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("movie_id"), F.col("l_quantity").alias("rating"))
    return mean_rating(li, "movie_id", "rating", 1, "rating")


@register("csv_ratings_mean", W(O.RATINGS_FULL_FILE) + """
SELECT CAST(movie_id AS INTEGER) AS movie_id, ROUND(AVG(rating), 1) AS rating
FROM rating_rows GROUP BY movie_id
""")
def csv_ratings_mean(spark, sf_dir):
    """One ratings file read by position with the declared schema."""
    return J.stage_ratings(spark, _files(spark, sf_dir).ratings_full)


@register("csv_glob_union_mean", W(O.RATINGS) + """
SELECT CAST(movie_id AS INTEGER) AS movie_id, rating FROM ratings
""")
def csv_glob_union_mean(spark, sf_dir):
    """Every file matching ratings* counts (the small file on top of the full one)."""
    return _ratings(spark, sf_dir)


@register("csv_folded_mean", W(O.RATINGS) + """
SELECT CAST(movie_id AS INTEGER) AS movie_id, rating FROM ratings
""")
def csv_folded_mean(spark, sf_dir):
    """The full file's state is stored, the small file is folded into it,
    and folding in both again adds nothing."""
    f, state = _files(spark, sf_dir), staging_dir(spark, "rating-state")
    J.fold_ratings(spark, state, f.ratings_full)
    J.fold_ratings(spark, state, f.ratings_small)
    return J.fold_ratings(spark, state, f.ratings_glob)


@register("csv_concat_distinct", W(O.LINKS) + """
SELECT movie_id, imdb_id, tmdb_id FROM links
""")
def csv_concat_distinct(spark, sf_dir):
    """Link files with different column orders, aligned by name, cleaned, distinct."""
    return _links(spark, sf_dir).valid


@register("clean_valid_rows", W(O.RAW_META, O.META_ANN, O.META) + """
SELECT * FROM meta
""")
def clean_valid_rows(spark, sf_dir):
    """The metadata contract (validators, sentinels, strip, dates, JSON, distinct)."""
    return _meta(spark, sf_dir).valid


@register("reject_reasons", W(O.RAW_META, O.META_ANN, O.LINKS, O.RATING_LINES) + f"""
SELECT 'movies_metadata' AS table_name, 'movies_metadata' AS folder, raw_id AS raw_key, unnest(reasons) AS reason
FROM meta_ann WHERE len(reasons) > 0
UNION ALL
SELECT 'movie_links' AS table_name, folder, movie_raw AS raw_key, unnest(reasons) AS reason
FROM links_ann WHERE len(reasons) > 0
UNION ALL
SELECT 'movie_ratings' AS table_name, folder, CAST(movie_id + {S.LONG_ID} AS VARCHAR) AS raw_key,
       'movie_id:out_of_range' AS reason
FROM rating_lines WHERE id_long
""")
def reject_reasons(spark, sf_dir):
    """The quarantine, one row per (raw key, reason), with the folder of
    the file that the row was read from."""
    f = _files(spark, sf_dir)

    def shown(table_name: str, rows: DataFrame) -> DataFrame:
        return rows.select(F.lit(table_name).alias("table_name"), F.regexp_extract("file", "([^/]+)/[^/]+$", 1).alias("folder"),
                           "raw_key", "reason")

    parts = [shown("movies_metadata", reject_rows(_meta(spark, sf_dir), "id")),
             shown("movie_links", reject_rows(_links(spark, sf_dir), "movieId")),
             shown("movie_ratings", reject_rows(J.stage_rating_rows(spark, f.ratings_glob), "movie_id")),
             shown("wiki_feed", J.feed_rejects(spark, f.feed).select(
                 "file", F.col("raw_record").alias("raw_key"), F.explode(REASONS).alias("reason")))]
    return reduce(DataFrame.unionByName, parts)


@register("date_parse_coerce", W(O.RAW_META) + f"""
SELECT order_key, {O.date_sql('release_date')} AS release_date,
       CAST(COALESCE(year({O.date_sql('release_date')}), -9999) AS INTEGER) AS year
FROM raw_meta
""")
def date_parse_coerce(spark, sf_dir):
    """F9 + P9 + F7 over every raw row: strict yyyy-M-d, else NULL; year or -9999."""
    raw = read_csv_text(spark, _files(spark, sf_dir).metadata, ["order_key", "release_date"])
    d = parse_ymd_date(F.col("release_date"))
    return raw.select(F.col("order_key").cast("bigint").alias("order_key"),
                      d.alias("release_date"),
                      F.coalesce(F.year(d), F.lit(-9999)).cast("int").alias("year"))


@register("literal_to_json", W(O.RAW_META) + """
SELECT order_key, genres_json AS genres, companies_json AS production_companies FROM raw_meta
""")
def literal_to_json(spark, sf_dir):
    """Python-literal lists -> canonical JSON (NULL when unreadable)."""
    raw = read_csv_text(spark, _files(spark, sf_dir).metadata,
                        ["order_key", "genres", "production_companies"])
    parsed = with_json_lists(raw, [(F.col("genres"), "g", "[]", "genres"),
                                   (F.col("production_companies"), "p", "[]",
                                    "production_companies")])
    return parsed.select(F.col("order_key").cast("bigint").alias("order_key"),
                         F.col("g").alias("genres"),
                         F.col("p").alias("production_companies"))


@register("xml_feed_clean", W(O.FEED) + """
SELECT title, wiki_url, wiki_abstract FROM feed
""")
def xml_feed_clean(spark, sf_dir):
    """XML feed read split-wise, prefix removed, trimmed, renamed."""
    return _feed(spark, sf_dir)


# ---- joins (J1-J3, J7) ----------------------------------------------------

@register("composite_key_join", W(O.RAW_META, O.META_ANN, O.META, O.LINKS, O.RATINGS, O.MOVIES) + """
SELECT * FROM movies
""")
def composite_key_join(spark, sf_dir):
    """J1 + J2 + F3: links x metadata on (tmdb_id, imdb_id) x ratings on movie_id."""
    return _movies(spark, sf_dir)


@register("sentinel_key_join", W(O.RAW_META, O.META_ANN, O.META, O.LINKS, O.equi_join(
    "pairs", "links", "meta", K.FILM_IDS, ["movie_id", "imdb_id", "tmdb_id"], ["title"])) + "SELECT * FROM pairs")
def sentinel_key_join(spark, sf_dir):
    """Missing ids kept as NULL and matched null-safely (<=>) give the same
    pairs as the sentinel-filled equi-join: two missing ids do join."""
    t = film_tables(spark, sf_dir, "movie_links", "movies_metadata")
    lk, m = t.links, t.metadata

    def unfill(df, cols):
        return df.select(*[F.nullif(F.col(c), F.lit(-9999)).alias(c) if c in cols else F.col(c)
                           for c in df.columns])
    a = unfill(lk, ["imdb_id", "tmdb_id"]).alias("a")
    b = unfill(m.select("tmdb_id", "imdb_id", "title"), ["imdb_id", "tmdb_id"]).alias("b")
    j = a.join(b, F.col("a.tmdb_id").eqNullSafe(F.col("b.tmdb_id"))
               & F.col("a.imdb_id").eqNullSafe(F.col("b.imdb_id")))
    return j.select(F.col("a.movie_id").alias("movie_id"),
                    F.coalesce(F.col("a.imdb_id"), F.lit(-9999)).alias("imdb_id"),
                    F.coalesce(F.col("a.tmdb_id"), F.lit(-9999)).alias("tmdb_id"),
                    F.col("b.title").alias("title"))


@register("xml_feed_title_join", W(O.RAW_META, O.META_ANN, O.META, O.LINKS, O.RATINGS, O.MOVIES, O.FEED) + """
SELECT mv.movie_id, mv.title, f.wiki_url, f.wiki_abstract
FROM movies mv JOIN feed f ON f.title = mv.title
""")
def xml_feed_title_join(spark, sf_dir):
    """Films x feed entries by exact title, many-to-many (every pair kept)."""
    mv = materialize(_movies(spark, sf_dir).select("movie_id", "title"), "film-rows")  # read twice
    feed = _feed_table(spark, sf_dir)
    # only entries of a film's title are shuffled with their abstracts
    feed = join_small_side(feed, materialize(mv.select("title").distinct(), "film-titles"), "title", "left_semi")
    return mv.join(feed, "title").select("movie_id", "title", "wiki_url", "wiki_abstract")


# ---- E5 and the reports -----------------------------------------------------

_TOP_CTES = O.FILM_ALL


@register("top_movies", W(*_TOP_CTES) + "\nSELECT * FROM top_movies\n")
def top_movies(spark, sf_dir):
    """E5: the top-ratio table computed from the staged tables and the XML
    feed (decimal ratio, dense top 1000, distinct)."""
    return J.top_movies(_movies(spark, sf_dir), _feed_table(spark, sf_dir), J.TOP_K, "decimal")


@register("top_movies_raw_feed", W(*_TOP_CTES) + "\nSELECT * FROM top_movies\n")
def top_movies_raw_feed(spark, sf_dir):
    """E5 straight from the feed file: titles are taken from the records' text,
    and only the winners' entries are parsed and joined."""
    feed = J.RawFeed.of(spark, _files(spark, sf_dir).feed)
    return J.top_movies(_movies(spark, sf_dir), feed, J.TOP_K, "decimal")


@register("sql_top_movies", W(*_TOP_CTES) + "\nSELECT * FROM top_movies\n")
def sql_top_movies(spark, sf_dir):
    """E5 written in Spark SQL over temp views (same result as ``top_movies``)."""
    return sql_reports.top_movies_sql(spark, _movies(spark, sf_dir),
                                      _feed_table(spark, sf_dir))


@register("top_movies_best_returns", W(*O.FILM_ALL[:-1], O.TOP_RETURNS) + "\nSELECT * FROM top_movies\n")
def top_movies_best_returns(spark, sf_dir):
    """E5 in the other direction (T13): revenue per unit of budget, so the
    top films are the strongest returns."""
    return J.top_movies(_movies(spark, sf_dir), _feed_table(spark, sf_dir), J.TOP_K,
                        "decimal", numerator="revenue", denominator="budget")


@register("top_movies_double_ratio", W(*O.FILM_ALL[:-1], O.TOP_DOUBLE) + "\nSELECT * FROM top_movies\n")
def top_movies_double_ratio(spark, sf_dir):
    """E5 with ``ratio_type="double"``: ratios rank as doubles (no 6-place ties)."""
    return J.top_movies(_movies(spark, sf_dir), _feed_table(spark, sf_dir), J.TOP_K, "double")


@register("json_explode_ordinality", W(O.RAW_META, O.META_ANN, O.META) + """
SELECT tmdb_id, title, CAST(pos AS INTEGER) AS position,
       CASE WHEN json_type(el, '$.id') IN ('BIGINT', 'UBIGINT')
            THEN TRY_CAST(json_extract_string(el, '$.id') AS BIGINT) END AS genre_id,
       json_extract_string(el, '$.name') AS genre
FROM (SELECT tmdb_id, title, unnest(arr) AS el, unnest(range(1, len(arr) + 1)) AS pos
      FROM (SELECT tmdb_id, title, json_extract(genres, '$[*]') AS arr FROM meta))
""")
def json_explode_ordinality(spark, sf_dir):
    """Every genre of every film as a row with its 1-based
    position (``jsonb_array_elements ... WITH ORDINALITY``); empty lists vanish.
    An id that is no integer, or none that fits a BIGINT, is NULL here."""
    m = _metadata_table(spark, sf_dir)
    out = explode_json_list(m, "genres", ["tmdb_id", "title"], "el", "position")
    return out.select("tmdb_id", "title", "position", F.col("el.id").alias("genre_id"),
                      F.col("el.name").alias("genre"))


@register("ratio_decimal_ties", W(O.RAW_META, O.META_ANN, O.META, O.LINKS, O.RATINGS, O.MOVIES) + f"""
, r AS (
  SELECT {O.RATIO6} AS ratio6,
         CASE WHEN revenue > 0 THEN budget / revenue ELSE -999.999 END AS ratio_double
  FROM movies
)
SELECT CAST(ratio6 AS DOUBLE) / 1000000.0 AS ratio, COUNT(*) AS num_rec,
       COUNT(DISTINCT ratio_double) AS num_double_values
FROM r GROUP BY ratio6 HAVING COUNT(*) > 1
""")
def ratio_decimal_ties(spark, sf_dir):
    """Ratios that tie at DECIMAL(38,6) — and how many distinct doubles
    each tie merges."""
    mv = _movies(spark, sf_dir).select(
        guarded_ratio(F.col("budget"), F.col("revenue"), "decimal").alias("ratio_dec"),
        guarded_ratio(F.col("budget"), F.col("revenue"), "double").alias("ratio_double"))
    g = mv.groupBy("ratio_dec").agg(F.count(F.lit(1)).alias("num_rec"),
                                    F.countDistinct("ratio_double").alias("num_double_values"))
    return g.filter(F.col("num_rec") > 1).select(
        F.col("ratio_dec").cast("double").alias("ratio"), "num_rec", "num_double_values")


@register("row_count", W(*_TOP_CTES) + "\nSELECT COUNT(*) AS num_rows FROM top_movies\n")
def row_count(spark, sf_dir):
    """R2."""
    return R.loaded_rows(_top(spark, sf_dir))


@register("shared_ratio_groups", W(*_TOP_CTES) + """
SELECT ratio, COUNT(*) AS num_rec FROM top_movies GROUP BY ratio HAVING COUNT(*) > 1
""")
def shared_ratio_groups(spark, sf_dir):
    """R3."""
    return R.shared_ratios(_top(spark, sf_dir))


@register("top_n_join", W(*_TOP_CTES, O.equi_join("pairs", "top_movies", "meta", ["title"], ["title", "ratio"], ["genres"]),
                          O.first_rows("best", "pairs", 5, ["ratio DESC", "title", "genres"]))
          + "SELECT title, ratio, genres FROM best")
def top_n_join(spark, sf_dir):
    """Genres of the 5 highest ratios (metadata matched on its raw title)."""
    return R.top_genres(_top(spark, sf_dir), _metadata_table(spark, sf_dir), 5)


@register("json_explode_filter", W(
    *_TOP_CTES, O.list_items("items", "meta", "genres", ["title"], "genre"),
    "wanted AS (SELECT * FROM items WHERE genre = 'URGENT')",
    O.equi_join("pairs", "wanted", "top_movies", ["title"], ["title", "genre"], ["wiki_url", "ratio"]),
    O.first_rows("best", "pairs", 10, ["ratio DESC", "title", "wiki_url"])) + "SELECT title, genre, wiki_url FROM best")
def json_explode_filter(spark, sf_dir):
    """Top films in one genre (genre 'URGENT' plays 'Comedy')."""
    return R.top_in_genre(_top(spark, sf_dir), _metadata_table(spark, sf_dir), "URGENT", 10)


@register("json_explode_dense_rank", W(
    *_TOP_CTES, O.list_items("items", "top_movies", "production_companies", ["title", "wiki_url", "wiki_abstract", "ratio"],
                             "production_company_name"),
    "steps AS (SELECT ratio, CAST(row_number() OVER (ORDER BY ratio DESC) AS INTEGER) AS ratio_rank "
    "FROM (SELECT DISTINCT ratio FROM items))",
    O.equi_join("pairs", "items", "steps", ["ratio"], ["title", "wiki_url", "wiki_abstract", "production_company_name"],
                ["ratio_rank"])) + "SELECT * FROM pairs WHERE ratio_rank <= 5")
def json_explode_dense_rank(spark, sf_dir):
    """Companies of the 5 best ratio ranks, ranked after the explode."""
    return R.top_rank_companies(_top(spark, sf_dir), 5)


# ---- constraints and table writes ----------------------------------------

def _key(cols):
    return "concat_ws('|', " + ", ".join(
        f"COALESCE(CAST({c} AS VARCHAR), 'NULL')" for c in cols) + ")"


def _dup_sql(table, src, cols, label):
    nn = " AND ".join(f"{c} IS NOT NULL" for c in cols)
    return (f"SELECT '{table}' AS table_name, '{label}' AS \"constraint\", {_key(cols)} AS key, "
            f"COUNT(*) AS num_rows FROM {src} WHERE {nn} GROUP BY {', '.join(cols)} HAVING COUNT(*) > 1")


def _row_sql(table, src, pred, label, key_cols):
    return (f"SELECT '{table}' AS table_name, '{label}' AS \"constraint\", {_key(key_cols)} AS key, "
            f"CAST(1 AS BIGINT) AS num_rows FROM {src} WHERE {pred}")


def _constraint_sql(table, src, contract):
    pk = list(contract.primary_key)
    parts = [
        _row_sql(table, src, " OR ".join(f"{c} IS NULL" for c in pk), "primary_key_null", pk),
        _dup_sql(table, src, pk, "primary_key_duplicate"),
    ]
    parts += [_dup_sql(table, src, list(u), "unique:" + ",".join(u)) for u in contract.unique]
    parts += [_row_sql(table, src, f"{c.name} IS NULL", f"not_null:{c.name}", pk)
              for c in contract.columns if not c.nullable]
    parts += [_row_sql(table, src, f"COALESCE(NOT ({chk.sql}), FALSE)", f"check:{chk.name}", pk)
              for chk in contract.checks]
    return "\nUNION ALL\n".join(parts)


@register("constraint_violations", W(O.RAW_META, O.META_ANN, O.META, O.LINKS, O.RATINGS) + "\n"
          + "\nUNION ALL\n".join([
              _constraint_sql("movies_metadata", "meta", K.MOVIES_METADATA),
              _constraint_sql("movie_links", "links", K.MOVIE_LINKS),
              _constraint_sql("movie_ratings", "ratings", K.MOVIE_RATINGS)]))
def constraint_violations_q(spark, sf_dir):
    """C1-C4 on the three staged tables."""
    t = film_tables(spark, sf_dir, "movie_links", "movies_metadata", "movie_ratings")
    parts = [
        constraint_violations(t.metadata, K.MOVIES_METADATA)
        .select(F.lit("movies_metadata").alias("table_name"), "*"),
        constraint_violations(t.links, K.MOVIE_LINKS)
        .select(F.lit("movie_links").alias("table_name"), "*"),
        constraint_violations(t.ratings, K.MOVIE_RATINGS)
        .select(F.lit("movie_ratings").alias("table_name"), "*"),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@register("top_movies_constraints", W(*_TOP_CTES) + "\n"
          + _constraint_sql("top_movies", "top_movies", K.TOP_MOVIES))
def top_movies_constraints(spark, sf_dir):
    """C1-C4 on the final table.  Its declared key (title, year, companies)
    is broken by the title fan-out itself (one film, several feed entries),
    so an all-or-nothing load of this table must refuse; the report says
    which keys."""
    return constraint_violations(_top(spark, sf_dir), K.TOP_MOVIES).select(
        F.lit("top_movies").alias("table_name"), "*")


@register("table_overwrite_append", W(O.RATINGS) + """
SELECT CAST(movie_id AS INTEGER) AS movie_id, CAST(2 AS BIGINT) AS copies, MAX(rating) AS rating
FROM ratings GROUP BY movie_id
""")
def table_overwrite_append(spark, sf_dir):
    """Overwrite a table, append the same rows again, read it back by
    name in SQL.  Plain appends check nothing; see ``table_checked_load``."""
    path = staging_dir(spark, "tables") + "/movie_ratings"
    ratings = materialize(_ratings(spark, sf_dir), "ratings")
    write_table(ratings, path, K.MOVIE_RATINGS, mode="overwrite")
    write_table(ratings, path, K.MOVIE_RATINGS, mode="append")
    return spark.sql("SELECT movie_id, COUNT(1) AS copies, MAX(rating) AS rating "
                     "FROM {movie_ratings} GROUP BY movie_id", movie_ratings=spark.read.parquet(path))


@register("table_checked_load", W(O.LINKS) + """
SELECT movie_id, imdb_id, tmdb_id, CAST(1 AS BIGINT) AS copies, true AS refused FROM links
""")
def table_checked_load(spark, sf_dir):
    """A clean batch of links is loaded; the urgent orders' links, which
    the table then has already, are refused as a whole."""
    path = staging_dir(spark, "tables") + "/movie_links"
    f = _files(spark, sf_dir)
    load_table(spark, J.stage_links(spark, [f.links_full, f.links_small]).valid, path, K.MOVIE_LINKS)
    refused = False
    try:
        load_table(spark, J.stage_links(spark, f.links_small).valid, path, K.MOVIE_LINKS)
    except ConstraintError as e:
        refused = not e.violations.filter("constraint = 'primary_key_duplicate'").isEmpty()
        discard_refused(spark, e)
    return spark.read.parquet(path).groupBy("movie_id", "imdb_id", "tmdb_id").agg(
        F.count("*").alias("copies")).withColumn("refused", F.lit(refused))


@register("dense_top_k_large", """
SELECT l_orderkey, l_linenumber, l_extendedprice, CAST(rk AS INTEGER) AS price_rank
FROM (SELECT l_orderkey, l_linenumber, l_extendedprice,
             DENSE_RANK() OVER (ORDER BY l_extendedprice DESC) AS rk FROM lineitem)
WHERE rk <= 5000
""")
def dense_top_k_large(spark, sf_dir):
    """W1 at k = 5000 over every lineitem (distinct-key form, no global sort)."""
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber",
                                                      "l_extendedprice")
    return dense_top_k(li, "l_extendedprice", 5000, rank_col="price_rank")


@register("dense_top_k_ties", """
SELECT l_orderkey, l_linenumber, l_discount, CAST(rk AS INTEGER) AS discount_rank
FROM (SELECT l_orderkey, l_linenumber, l_discount,
             DENSE_RANK() OVER (ORDER BY l_discount DESC) AS rk FROM lineitem)
WHERE rk <= 3
""")
def dense_top_k_ties(spark, sf_dir):
    """W1 under heavy ties: the 3 best distinct discounts cover about a
    quarter of all lineitems; every tied row is kept, none goes through a
    single-task window."""
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_discount")
    return dense_top_k(li, "l_discount", 3, rank_col="discount_rank")


def queries() -> dict[str, Builder]:
    return {name: fn for name, (fn, _) in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, (_, sql) in REGISTRY.items() if sql}
