"""Jobs on small inline tables: sentinel joins, fan-out, explode, constraints."""

from pyspark.sql import functions as F

from marquee import contracts as K
from marquee.operators.quality import constraint_violations
from marquee.plans import jobs as J
from marquee.plans import reports as R


def frames(spark):
    links = spark.createDataFrame(
        [(1, 100, 10), (2, 200, 20), (3, 300, -9999), (4, 400, 40)],
        "movie_id int, imdb_id int, tmdb_id int")
    meta = spark.createDataFrame([
        (10, 100, '[{"id":1,"name":"Comedy"}]', "Alpha", "Alpha", 2000.0, "2001-05-01", 1000.0,
         '[{"id":7,"name":"A Co"},{"id":8,"name":"B Co"}]'),
        (20, 200, "[]", "Beta", " Beta ", 500.0, None, 1000.0, "[]"),
        (-9999, 300, "[]", "Gamma", "Gamma", 10.0, "1999-01-01", 0.0, '[{"id":9,"name":"C Co"}]'),
        (40, 400, "[]", "Alpha", "Alpha", 100.0, "2003-01-01", 1000.0, '[{"id":9,"name":"C Co"}]'),
    ], "tmdb_id int, imdb_id int, genres string, original_title string, title string, "
       "budget double, release_date string, revenue double, production_companies string"
    ).withColumn("release_date", F.to_date("release_date"))
    ratings = spark.createDataFrame([(1, 3.5), (2, 4.0), (3, 1.0), (4, 2.0)],
                                    "movie_id int, rating double")
    feed = spark.createDataFrame([("Alpha", "u1", "a1"), ("Alpha", "u2", "a2"),
                                  ("Beta", "u3", "b"), ("Gamma", "u4", "g")],
                                 "title string, wiki_url string, wiki_abstract string")
    return links, meta, ratings, feed


def test_sentinel_ids_join_and_title_trim(spark):
    links, meta, ratings, _ = frames(spark)
    movies = J.linked_movies(links, meta, ratings)
    got = {r.movie_id: r.title for r in movies.collect()}
    assert got == {1: "Alpha", 2: "Beta", 3: "Gamma", 4: "Alpha"}


def test_top_movies_fanout_and_ranks(spark):
    links, meta, ratings, feed = frames(spark)
    movies = J.linked_movies(links, meta, ratings)
    top = J.top_movies(movies, feed, k=2, materialize=False)
    got = sorted((r.title, r.ratio, r.wiki_url, r.year) for r in top.collect())
    # ratios: Alpha#1 2.0, Beta 0.5, Gamma -999.999, Alpha#4 0.1 -> top 2 distinct: 2.0, 0.5
    assert got == [("Alpha", 2.0, "u1", 2001), ("Alpha", 2.0, "u2", 2001), ("Beta", 0.5, "u3", -9999)]
    window = J.top_movies_window(movies, feed, k=2)
    assert sorted(map(tuple, top.collect())) == sorted(map(tuple, window.collect()))
    mat = J.top_movies(movies, feed, k=2, materialize=True)
    assert sorted(map(tuple, mat.collect())) == sorted(map(tuple, top.collect()))


def test_reports(spark):
    links, meta, ratings, feed = frames(spark)
    top = J.top_movies(J.linked_movies(links, meta, ratings), feed, k=10, materialize=False)
    assert R.schema_probe(top).count() == 0
    assert R.loaded_rows(top).first().num_rows == top.count()
    shared = {r.ratio: r.num_rec for r in R.shared_ratios(top).collect()}
    assert shared == {2.0: 2, 0.1: 2}  # both 'Alpha' films fan out to two entries
    comedies = R.top_in_genre(top, meta, "Comedy", 10).collect()
    # the genre is matched by title, so both 'Alpha' films qualify
    assert sorted(r.wiki_url for r in comedies) == ["u1", "u1", "u2", "u2"]
    companies = R.top_rank_companies(top, 5).collect()
    names = sorted((r.production_company_name, r.ratio_rank) for r in companies)
    # Beta has no company: it vanishes before ranking, so Gamma moves up.
    assert ("C Co", 3) in names and all(n != "Beta" for n, _ in names)
    genres = R.top_genres(top, meta, 5).collect()
    assert all(r.title != "Beta" for r in genres)  # raw ' Beta ' does not match


def test_constraint_violations(spark):
    meta = spark.createDataFrame(
        [(-9999, 1, None, "a", 1.0, 2.0), (-9999, 2, None, "b", 1.0, 2.0), (5, 3, None, None, 1.0, 2.0)],
        "tmdb_id int, imdb_id int, release_date date, original_title string, budget double, revenue double")
    got = sorted(map(tuple, constraint_violations(meta, K.MOVIES_METADATA).collect()))
    assert ("primary_key_duplicate", "-9999", 2) in got
    assert ("not_null:original_title", "5", 1) in got
    ratings = spark.createDataFrame([(1, 5.5), (2, None), (2, 3.0)], "movie_id int, rating double")
    got = sorted(map(tuple, constraint_violations(ratings, K.MOVIE_RATINGS).collect()))
    assert got == [("check:rating_at_most_5", "1", 1), ("primary_key_duplicate", "2", 2)]


def test_load_table_is_all_or_nothing(spark, tmp_dir):
    import pytest
    from marquee.sources.tables import ConstraintError, load_table
    path = f"{tmp_dir}/ratings"
    first = spark.createDataFrame([(1, 3.0), (2, 4.0)], "movie_id int, rating double")
    load_table(spark, first, path, K.MOVIE_RATINGS, mode="overwrite")
    dup = spark.createDataFrame([(2, 1.0), (3, 2.0)], "movie_id int, rating double")
    with pytest.raises(ConstraintError) as err:
        load_table(spark, dup, path, K.MOVIE_RATINGS, mode="append")
    assert [tuple(r) for r in err.value.violations.collect()] == [("primary_key_duplicate", "2", 2)]
    assert spark.read.parquet(path).count() == 2  # nothing was written
    load_table(spark, dup.filter("movie_id = 3"), path, K.MOVIE_RATINGS, mode="append")
    assert spark.read.parquet(path).count() == 3


def test_run_all_can_enforce_constraints(spark, tmp_dir):
    import os

    import pytest
    from marquee.sources.tables import ConstraintError
    os.makedirs(f"{tmp_dir}/in", exist_ok=True)
    with open(f"{tmp_dir}/in/meta.csv", "w") as fh:
        fh.write("id,imdb_id,genres,original_title,title,budget,release_date,revenue,production_companies\n"
                 "862,tt1,[],A,A,10,1995-10-30,5,[]\n")
    with open(f"{tmp_dir}/in/links.csv", "w") as fh:
        fh.write("movieId,imdbId,tmdbId\n1,1,862\n")
    with open(f"{tmp_dir}/in/ratings.csv", "w") as fh:
        fh.write("userId,movieId,rating,timestamp\n1,1,9.0,1\n")  # breaks CHECK rating <= 5
    feed = spark.createDataFrame([("Wikipedia: A", "u", "a")], "title string, url string, abstract string")
    from marquee.sources.xml import write_xml_feed
    write_xml_feed(feed, f"{tmp_dir}/in/feed")
    args = dict(metadata_csv=f"{tmp_dir}/in/meta.csv", link_csvs=[f"{tmp_dir}/in/links.csv"],
                ratings_glob=f"{tmp_dir}/in/ratings*.csv", feed_xml=f"{tmp_dir}/in/feed")
    with pytest.raises(ConstraintError):
        J.run_all(spark, f"{tmp_dir}/strict", enforce_constraints=True, **args)
    t = J.run_all(spark, f"{tmp_dir}/lenient", **args)
    assert t.top.count() == 1


def test_driver_tables_by_name(spark):
    from marquee.sources.tables import register_views
    register_views(spark, "/root/testdata/sf0.001", ["orders", "lineitem"])
    n = spark.sql("SELECT count(*) AS n FROM orders o JOIN lineitem l "
                  "ON l.l_orderkey = o.o_orderkey").first().n
    assert n == spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").count()


def test_raw_feed_parses_winners_only(spark, tmp_dir):
    """E5 from the feed file: same rows as from the parsed feed, and of 400
    records only the winners' and those with a title that is not plain are
    parsed; a title whose only record is unreadable takes no part."""
    docs = [f"<doc><title>Wikipedia: T{i}</title><url>u{i}</url><abstract>a &amp; {i}</abstract></doc>" for i in range(400)]
    docs[7] = "<doc><title>Wikipedia: T7</title><url>u</doc>"
    docs[8] = "<doc><title>Wikipedia: <![CDATA[T8]]></title><url>u8</url><abstract>x</abstract></doc>"
    docs[9] = "<doc><title lang='x'>Wikipedia: T9</title><url>u9</url><abstract>&lt;title></abstract></doc>"
    docs += ["<doc><title>Wikipedia: T5</title><url>again</url><abstract><![CDATA[<title>T1</title>]]></abstract></doc>"]
    with open(f"{tmp_dir}/f.xml", "w") as f:
        f.write("<feed>\n" + "\n".join(docs) + "</feed>")
    movies = spark.createDataFrame(
        [(i, i, f"T{i}", float(1000 - i), None, 1.0, "[]", 3.0) for i in range(390)],
        "movie_id int, imdb_id int, title string, budget double, release_date date, revenue double, production_companies string, rating double")
    feed = J.RawFeed.of(spark, f"{tmp_dir}/f.xml")
    got = J.top_movies(movies, feed, 12)
    want = J.top_movies(movies, J.read_clean_feed(spark, f"{tmp_dir}/f.xml"), 12)
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
    assert {r.title for r in got.collect()} == {f"T{i}" for i in range(13)} - {"T7"}
    titles = want.select("title").distinct()
    assert feed.wanted(titles).count() < 20
    plan = feed.entries(titles)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("from_xml") < plan.rindex("Join")  # the join on plain titles is below the parse
