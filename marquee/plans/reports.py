"""The analyst reports on the finished tables (R1..R6).

Each takes the ``top_movies`` (and where needed ``movies_metadata``) frames
and returns a DataFrame.  ORDER BY ... LIMIT reports end their ordering with
columns that make the order total, so the answer never depends on which task
finishes first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.operators.aggregate import empty_like, row_count, value_groups
from marquee.operators.explode import explode_names
from marquee.operators.rank import dense_top_k, top_n


def schema_probe(top: DataFrame) -> DataFrame:
    """``SELECT * FROM top_movies WHERE 1 = 2``."""
    return empty_like(top)


def loaded_rows(top: DataFrame) -> DataFrame:
    """R2: ``SELECT count(1) FROM top_movies``."""
    return row_count(top, "num_rows")


def shared_ratios(top: DataFrame) -> DataFrame:
    """Ratios carried by more than one row (the ties dense rank keeps)."""
    return value_groups(top, "ratio", 2, "num_rec")


def top_genres(top: DataFrame, metadata: DataFrame, n: int = 5) -> DataFrame:
    """Genres of the ``n`` highest-ratio rows (metadata matched on its raw title)."""
    t = top.select("title", "ratio")
    m = metadata.select(F.col("title").alias("m_title"), "genres")
    j = t.join(m, t.title == m.m_title, "inner").select("title", "ratio", "genres")
    return top_n(j, n, F.col("ratio").desc(), F.col("title"), F.col("genres"))


def top_in_genre(top: DataFrame, metadata: DataFrame, genre: str, n: int = 10) -> DataFrame:
    """The ``n`` highest-ratio top rows whose film (by title) lists ``genre``."""
    g = explode_names(metadata, "genres", ["title"], "genre").filter(F.col("genre") == genre)
    g = g.select(F.col("title").alias("g_title"), "genre")
    t = top.select("title", "ratio", "wiki_url")
    j = g.join(t, g.g_title == t.title, "inner").select("title", "genre", "wiki_url", "ratio")
    ranked = top_n(j, n, F.col("ratio").desc(), F.col("title"), F.col("wiki_url"))
    return ranked.select("title", "genre", "wiki_url")


def top_rank_companies(top: DataFrame, k: int = 5) -> DataFrame:
    """Production companies of the rows in the ``k`` best ratio ranks,
    ranked after the explode (films without companies take no rank)."""
    exploded = explode_names(top, "production_companies",
                             ["title", "wiki_url", "wiki_abstract", "ratio"],
                             "production_company_name")
    ranked = dense_top_k(exploded, "ratio", k, rank_col="ratio_rank")
    return ranked.select("title", "wiki_url", "wiki_abstract", "production_company_name",
                         "ratio_rank")
