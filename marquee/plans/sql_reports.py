"""E5 as Spark SQL text, for analysts who write SQL.

The frames are passed to ``spark.sql`` as arguments, so no temp view of the
caller's session is touched.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from marquee.operators.joins import BROADCAST_MAX_BYTES

# E5 over ``linked_movies`` (links x metadata x ratings) and ``feed`` (cleaned encyclopedia entries): semi-join on distinct titles, rank
# on the distinct ratios (DECIMAL(38,6) like the database path), broadcast the
# k best back, fan out to the feed last.
TOP_MOVIES_SQL = """
WITH matched AS (
  SELECT m.* FROM {linked_movies} m LEFT SEMI JOIN (SELECT DISTINCT title FROM {feed}) t
    ON m.title = t.title),
scored AS (
  SELECT title, budget, year(release_date) AS year, revenue, rating, production_companies,
         CASE WHEN revenue > 0
              THEN try_divide(TRY_CAST(budget AS DECIMAL(38,18)), TRY_CAST(revenue AS DECIMAL(38,18)))
              ELSE CAST(-999.999 AS DECIMAL(38,6)) END AS ratio
  FROM matched),
best AS (SELECT DISTINCT ratio FROM scored ORDER BY ratio DESC NULLS LAST LIMIT {k})
SELECT {hint} DISTINCT s.title, CAST(s.budget AS DOUBLE) AS budget,
       CAST(coalesce(s.year, -9999) AS INT) AS year, CAST(s.revenue AS DOUBLE) AS revenue,
       s.rating, CAST(s.ratio AS DOUBLE) AS ratio, s.production_companies,
       f.wiki_url, f.wiki_abstract
FROM scored s
JOIN best b ON s.ratio <=> b.ratio
JOIN {feed} f ON f.title = s.title
"""


def top_movies_sql(spark: SparkSession, movies: DataFrame, feed: DataFrame,
                   k: int = 1000) -> DataFrame:
    """E5 written in Spark SQL (see ``TOP_MOVIES_SQL``).  The ranks, 32 bytes
    each at most, are broadcast while ``k`` of them stay within the library's
    limit."""
    hint = "/*+ BROADCAST(b) */" if k * 32 <= BROADCAST_MAX_BYTES else ""
    return spark.sql(TOP_MOVIES_SQL.replace("{hint}", hint).replace("{k}", str(int(k))),
                     linked_movies=movies, feed=feed)
