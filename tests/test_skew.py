"""A third of all rows on one key: results stay whole and plans stay partial."""

from pyspark.sql import functions as F

from marquee.operators.aggregate import mean_rating
from marquee.operators.rank import dense_top_k, dense_top_k_window
from marquee.plans import jobs as J

N = 30_000


def hot_frame(spark):
    # id % 3 == 0 -> the hot value 7.0 (a third of the rows), others spread
    return spark.range(0, N).select(
        F.col("id"),
        F.when(F.col("id") % 3 == 0, F.lit(7.0)).otherwise((F.col("id") % 1000) / 100.0).alias("v"))


def test_dense_top_k_hot_value_whole(spark):
    df = hot_frame(spark)
    got = dense_top_k(df, "v", 300)
    want = dense_top_k_window(df, "v", 300)
    assert got.count() == want.count()
    assert got.filter(F.col("id") % 3 == 0).count() == N // 3  # every hot row kept
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_distinct_and_mean_aggregate_partially(spark):
    df = hot_frame(spark)
    plan = dense_top_k(df, "v", 10)._jdf.queryExecution().executedPlan().toString()
    # the distinct runs as partial + final HashAggregate around the exchange
    assert plan.count("HashAggregate") >= 2
    m = mean_rating(df.select((F.col("id") % 3 == 0).cast("int").alias("movie_id"),
                              F.col("v").alias("rating")))
    mplan = m._jdf.queryExecution().executedPlan().toString()
    assert "partial_avg" in mplan
    got = {r.movie_id: r.rating for r in m.collect()}
    assert got[1] == 7.0


def test_hot_title_fanout_is_whole(spark):
    films = spark.range(0, 300).select(
        F.col("id").cast("int").alias("movie_id"), F.lit(1).alias("imdb_id"),
        F.when(F.col("id") % 3 == 0, F.lit("Hot")).otherwise(F.concat(F.lit("T"), F.col("id"))).alias("title"),
        (F.col("id") + 1).cast("double").alias("budget"), F.to_date(F.lit("2000-01-01")).alias("release_date"),
        F.lit(10.0).alias("revenue"), F.lit("[]").alias("production_companies"), F.lit(3.0).alias("rating"))
    feed = spark.range(0, 90).select(
        F.when(F.col("id") % 3 == 0, F.lit("Hot")).otherwise(F.concat(F.lit("T"), F.col("id"))).alias("title"),
        F.concat(F.lit("u"), F.col("id")).alias("wiki_url"), F.lit("a").alias("wiki_abstract"))
    got = J.top_movies(films, feed, k=1000, materialize=True)
    want = J.top_movies_window(films, feed, k=1000)
    # 100 hot films x 30 hot entries, plus the plain matches
    assert got.filter(F.col("title") == "Hot").count() == 100 * 30
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
