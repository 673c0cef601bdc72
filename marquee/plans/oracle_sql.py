"""DuckDB SQL that recomputes every registered query from the driver tables.

Written independently of the Spark code: it regenerates the raw film inputs
with the same defect table (``standins.DIRT``) and then applies the cleaning,
joining and ranking rules in plain SQL.  JSON lists are produced directly in
canonical form from the source columns (DuckDB has no Python-literal parser);
the Spark side must recover the same lists by parsing the literal text.
"""

from __future__ import annotations

from marquee.contracts import FILM_IDS as K_FILM_IDS
from marquee.plans.standins import DIRT, FEED_DOCS_PER_TITLE, FEED_URL

INT_PAT = "^[0-9]+$"
FLOAT_PAT = r"^[0-9]+\.?[0-9]*$"
NUM_PAT = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
DATE_PAT = "^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$"


def hit(key: str, name: str) -> str:
    return f"(({key}) % {DIRT[name]} = 0)"


def strict_int_sql(c: str, label: str) -> tuple[str, str]:
    ok = f"(regexp_matches({c}, '{INT_PAT}') OR {c} = '-9999')"
    value = f"CASE WHEN {c} IS NULL THEN -9999 WHEN {ok} THEN TRY_CAST({c} AS INTEGER) END"
    reason = (f"CASE WHEN {c} IS NULL THEN NULL WHEN NOT {ok} THEN '{label}:not_integer' "
              f"WHEN TRY_CAST({c} AS INTEGER) IS NULL THEN '{label}:out_of_range' END")
    return value, reason


def numeric_int_sql(c: str, label: str) -> tuple[str, str]:
    t = f"trim({c})"
    typed = f"TRY_CAST(trunc(TRY_CAST({t} AS DOUBLE)) AS INTEGER)"
    ok = f"regexp_matches({t}, '{NUM_PAT}')"
    value = f"CASE WHEN {c} IS NULL THEN -9999 WHEN {ok} THEN {typed} END"
    reason = (f"CASE WHEN {c} IS NULL THEN NULL WHEN NOT {ok} THEN '{label}:not_numeric' "
              f"WHEN {typed} IS NULL THEN '{label}:out_of_range' END")
    return value, reason


def strict_float_sql(c: str, label: str) -> tuple[str, str]:
    ok = f"(regexp_matches({c}, '{FLOAT_PAT}') OR {c} = '-999.999')"
    value = f"CASE WHEN {c} IS NULL THEN -999.999 WHEN {ok} THEN TRY_CAST({c} AS DOUBLE) END"
    reason = (f"CASE WHEN {c} IS NULL THEN NULL WHEN NOT {ok} THEN '{label}:not_decimal' "
              f"WHEN TRY_CAST({c} AS DOUBLE) IS NULL OR TRY_CAST({c} AS DOUBLE) >= 1e20 "
              f"THEN '{label}:out_of_range' END")
    return value, reason


def date_sql(c: str) -> str:
    return f"CASE WHEN regexp_matches({c}, '{DATE_PAT}') THEN CAST(TRY_STRPTIME({c}, '%Y-%m-%d') AS DATE) END"


K = "o.o_orderkey"

RAW_META = f"""
raw_meta AS (
  SELECT {K} AS order_key,
    CASE WHEN {hit(K, 'id_null')} THEN NULL WHEN {hit(K, 'id_date')} THEN '1997-08-20'
         WHEN {hit(K, 'id_overflow')} THEN '99999999999' ELSE CAST({K} AS VARCHAR) END AS id,
    CASE WHEN {hit(K, 'imdb_bare')} THEN 'tt' ELSE printf('tt%07d', o.o_custkey) END AS imdb_id,
    CASE WHEN {hit(K, 'genres_null')} THEN '[]' WHEN {hit(K, 'genres_object')} THEN NULL
         WHEN {hit(K, 'genres_extra_key')} THEN '[{{"id":1,"name":"URGENT","note":null}}]'
         WHEN {hit(K, 'genres_quoted_id')} THEN '[{{"id":"1","name":"URGENT"}}]'
         WHEN {hit(K, 'genres_float_id')} THEN '[{{"id":1.5,"name":"URGENT"}}]'
         WHEN {hit(K, 'genres_long_id')} THEN '[{{"id":12345678901234567890,"name":"URGENT"}}]'
         WHEN {hit(K, 'genres_overflow')} THEN NULL
         ELSE to_json([{{'id': CAST(substr(o.o_orderpriority, 1, 1) AS BIGINT),
                         'name': split_part(o.o_orderpriority, '-', 2)}},
                       {{'id': CAST(10 AS BIGINT), 'name': o.o_orderstatus}}]) END AS genres_json,
    CASE WHEN {hit(K, 'original_title_null')} THEN NULL ELSE c.c_name END AS original_title,
    CASE WHEN {hit(K, 'title_padded')} THEN ' ' || c.c_name || '  ' ELSE c.c_name END AS title,
    CASE WHEN {hit(K, 'budget_exponent')} THEN '1e6' WHEN {hit(K, 'budget_null')} THEN NULL
         WHEN {hit(K, 'budget_huge')} THEN '1000000000000000000000'
         WHEN {hit(K, 'budget_negative')} THEN '-5' WHEN {hit(K, 'budget_trailing_dot')} THEN '1.'
         ELSE CAST(CAST(o.o_totalprice AS DECIMAL(18,2)) AS VARCHAR) END AS budget,
    CASE WHEN {hit(K, 'date_padded')} THEN ' ' || strftime(o.o_orderdate, '%Y-%m-%d')
         WHEN {hit(K, 'date_unpadded')} THEN strftime(o.o_orderdate, '%Y-%-m-%-d')
         ELSE strftime(o.o_orderdate, '%Y-%m-%d') END AS release_date,
    CASE WHEN {hit(K, 'revenue_zero')} THEN '0' WHEN {hit(K, 'revenue_null')} THEN NULL
         ELSE CAST(r.rev AS VARCHAR) END AS revenue,
    CASE WHEN {hit(K, 'companies_empty')} THEN '[]'
         WHEN {hit(K, 'companies_none')} THEN to_json([{{'id': CAST(n.n_nationkey AS BIGINT), 'name': CAST(NULL AS VARCHAR)}}])
         WHEN {hit(K, 'companies_junk')} THEN NULL
         WHEN {hit(K, 'companies_trailing')} THEN NULL
         WHEN {hit(K, 'companies_slash')} THEN '[{{"id":1,"name":"a\\\\/b"}}]'
         WHEN {hit(K, 'companies_surrogate')} THEN NULL
         WHEN {hit(K, 'companies_apostrophe')} THEN to_json([{{'id': CAST(n.n_nationkey AS BIGINT), 'name': n.n_name || '''s Films'}}])
         WHEN {hit(K, 'companies_escape')} THEN to_json([{{'id': CAST(n.n_nationkey AS BIGINT), 'name': 'café ' || n.n_name}}])
         ELSE to_json([{{'id': CAST(n.n_nationkey AS BIGINT), 'name': n.n_name}},
                       {{'id': CAST(100 AS BIGINT), 'name': c.c_mktsegment}}]) END AS companies_json
  FROM orders o
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  LEFT JOIN (SELECT l_orderkey, SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS rev
             FROM lineitem GROUP BY l_orderkey) r ON r.l_orderkey = o.o_orderkey
)"""

_tm_v, _tm_r = strict_int_sql("id", "tmdb_id")
_im_v, _im_r = strict_int_sql("ltrim(imdb_id, 't')", "imdb_id")
_bu_v, _bu_r = strict_float_sql("budget", "budget")
_re_v, _re_r = strict_float_sql("revenue", "revenue")

META_ANN = f"""
meta_ann AS (
  SELECT order_key, id AS raw_id,
    {_tm_v} AS tmdb_id, {_im_v} AS imdb_id, genres_json AS genres, original_title, title,
    {_bu_v} AS budget, {date_sql('release_date')} AS release_date, {_re_v} AS revenue,
    companies_json AS production_companies,
    list_filter([{_tm_r}, {_im_r},
                 CASE WHEN genres_json IS NULL THEN 'genres:' ||
                      CASE WHEN {hit('order_key', 'genres_object')} THEN 'not_a_list' ELSE 'unparseable' END END,
                 CASE WHEN original_title IS NULL THEN 'original_title:null' END,
                 {_bu_r}, {_re_r},
                 CASE WHEN companies_json IS NULL THEN 'production_companies:' ||
                      CASE WHEN {hit('order_key', 'companies_junk')} THEN 'not_a_list' ELSE 'unparseable' END END],
                lambda x: x IS NOT NULL) AS reasons
  FROM raw_meta
)"""

META = """
meta AS (
  SELECT DISTINCT tmdb_id, imdb_id, genres, original_title, title, budget, release_date,
         revenue, production_companies
  FROM meta_ann WHERE len(reasons) = 0
)"""

LK = "o_orderkey"
_RAW_LINK_COLS = f"""CAST({LK} AS VARCHAR) AS movie_raw,
    CASE WHEN {hit(LK, 'link_imdb_float')} THEN CAST(o_custkey AS VARCHAR) || '.0'
         ELSE CAST(o_custkey AS VARCHAR) END AS imdb_raw,
    CASE WHEN {hit(LK, 'link_tmdb_null')} THEN NULL WHEN {hit(LK, 'link_tmdb_text')} THEN 'x'
         ELSE CAST({LK} AS VARCHAR) END AS tmdb_raw"""
_mv_v, _mv_r = numeric_int_sql("movie_raw", "movie_id")
_li_v, _li_r = numeric_int_sql("imdb_raw", "imdb_id")
_lt_v, _lt_r = numeric_int_sql("tmdb_raw", "tmdb_id")

LINKS = f"""
raw_links AS (
  SELECT 'links' AS folder, {_RAW_LINK_COLS} FROM orders
  UNION ALL
  SELECT 'links_small' AS folder, {_RAW_LINK_COLS} FROM orders WHERE o_orderpriority = '1-URGENT'
),
links_ann AS (
  SELECT folder, movie_raw, {_mv_v} AS movie_id, {_li_v} AS imdb_id, {_lt_v} AS tmdb_id,
    list_filter([{_mv_r}, {_li_r}, {_lt_r}], lambda x: x IS NOT NULL) AS reasons
  FROM raw_links
),
links AS (SELECT DISTINCT movie_id, imdb_id, tmdb_id FROM links_ann WHERE len(reasons) = 0)"""

RK = "l_orderkey + l_linenumber"
_RATING_ROWS = f"""SELECT l_orderkey AS movie_id, {hit(RK, 'rating_id_long')} AS id_long,
         CASE WHEN {hit(RK, 'rating_text')} THEN NULL ELSE l_quantity END AS rating
  FROM lineitem"""
RATINGS_FULL_FILE = f"""
rating_rows AS (SELECT * FROM ({_RATING_ROWS}) WHERE NOT id_long)"""
RATING_LINES = f"""
rating_lines AS (
  SELECT *, 'ratings' AS folder FROM ({_RATING_ROWS})
  UNION ALL SELECT *, 'ratings_small' AS folder FROM ({_RATING_ROWS} WHERE l_returnflag = 'R'))"""
RATINGS = RATING_LINES + """,
rating_rows AS (SELECT * FROM rating_lines WHERE NOT id_long),
ratings AS (SELECT movie_id, ROUND(AVG(rating), 1) AS rating FROM rating_rows GROUP BY movie_id)"""

DK = "doc_id"
_NAME = f"printf('Customer#%09d', {DK} // {FEED_DOCS_PER_TITLE})"
FEED = f"""
feed AS (
  SELECT trim(regexp_replace(
           CASE WHEN {hit(DK, 'feed_prefix_space')} THEN ' Wikipedia: ' || {_NAME}
                WHEN {hit(DK, 'feed_title_padded')} THEN 'Wikipedia:  ' || {_NAME} || '   '
                ELSE 'Wikipedia: ' || {_NAME} END, '^Wikipedia:', '')) AS title,
         trim('{FEED_URL}' || CAST({DK} AS VARCHAR)) AS wiki_url,
         trim(text) AS wiki_abstract
  FROM documents
)"""



# Joins, lists and leading rows are generated from the operators' definitions:
# the keys declared in ``contracts`` and the columns that a query returns.

def equi_join(name: str, left: str, right: str, keys, left_cols, right_cols) -> str:
    """CTE ``name``: rows of both sides that agree on every key."""
    cols = [f"a.{c}" for c in left_cols] + [f"b.{c}" for c in right_cols]
    on = " AND ".join(f"a.{k} = b.{k}" for k in keys)
    return f"\n{name} AS (SELECT {', '.join(cols)} FROM {left} a JOIN {right} b ON {on})"


def list_items(name: str, source: str, column: str, keep, item: str) -> str:
    """CTE ``name``: one row for each element of a JSON list, with its name."""
    kept = ", ".join(keep)
    return (f"\n{name} AS (SELECT {kept}, json_extract_string(element, '$.name') AS {item} "
            f"FROM (SELECT {kept}, unnest(json_extract({column}, '$[*]')) AS element FROM {source}))")


def first_rows(name: str, source: str, n: int, order) -> str:
    """CTE ``name``: the first ``n`` rows in a total order."""
    return (f"\n{name} AS (SELECT * FROM (SELECT *, row_number() OVER (ORDER BY {', '.join(order)}) AS place "
            f"FROM {source}) WHERE place <= {n})")


MOVIES = ",".join([
    equi_join("described", "links", "meta", K_FILM_IDS, ["movie_id", "imdb_id"],
              ["title", "budget", "release_date", "revenue", "production_companies"]),
    equi_join("rated", "described", "ratings", ["movie_id"],
              ["movie_id", "imdb_id", "title", "budget", "release_date", "revenue", "production_companies"], ["rating"]),
    "\nmovies AS (SELECT * REPLACE (trim(title) AS title) FROM rated)"])

# ratio = HALF_UP(budget / revenue, 6) computed exactly on integers (money
# values carry at most three decimals): sign(b) * floor((2e6*|b| + p) / 2p).
_B = "CAST(round(budget * 1000) AS HUGEINT)"
_P = "CAST(round(revenue * 1000) AS HUGEINT)"
RATIO6 = (f"CASE WHEN revenue > 0 THEN sign({_B}) * ((2000000 * abs({_B}) + {_P}) // (2 * {_P})) "
          f"ELSE -999999000 END")

def top_cte(ratio_key: str, ratio_out: str, name: str = "top_movies") -> str:
    """E5 in SQL: join, ratio, global DENSE_RANK window, distinct."""
    return f"""
joined AS (
  SELECT mv.*, f.wiki_url, f.wiki_abstract FROM movies mv JOIN feed f ON f.title = mv.title
),
ratioed AS (
  SELECT title, budget, year(release_date) AS year, revenue, rating, {ratio_key} AS ratio_key,
         production_companies, wiki_url, wiki_abstract
  FROM joined
),
ranked AS (SELECT *, DENSE_RANK() OVER (ORDER BY ratio_key DESC) AS rk FROM ratioed),
{name} AS (
  SELECT DISTINCT title, CAST(budget AS DOUBLE) AS budget,
         CAST(COALESCE(year, -9999) AS INTEGER) AS year, CAST(revenue AS DOUBLE) AS revenue,
         rating, {ratio_out} AS ratio, production_companies, wiki_url, wiki_abstract
  FROM ranked WHERE rk <= 1000
)"""


# Same rounding with numerator and denominator swapped (revenue per budget).
RATIO6_RETURNS = (f"CASE WHEN budget > 0 THEN sign({_P}) * ((2000000 * abs({_P}) + {_B}) // (2 * {_B})) "
                  f"ELSE -999999000 END")

TOP = top_cte(RATIO6, "CAST(ratio_key AS DOUBLE) / 1000000.0")
TOP_RETURNS = top_cte(RATIO6_RETURNS, "CAST(ratio_key AS DOUBLE) / 1000000.0")
TOP_DOUBLE = top_cte("CASE WHEN revenue > 0 THEN budget / revenue ELSE -999.999 END", "ratio_key")


def with_(*ctes: str) -> str:
    return "WITH " + ",".join(ctes)


FILM_ALL = (RAW_META, META_ANN, META, LINKS, RATINGS, FEED, MOVIES, TOP)
