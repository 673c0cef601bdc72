"""Inputs that used to lose or change data, loads, and what a job leaves behind."""

import gzip
import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from marquee import contracts as K
from marquee import session
from marquee.operators import quality
from marquee.operators.rank import BOUND_PARTS, dense_top_k, dense_top_k_window
from marquee.plans import jobs as J
from marquee.sources import tables
from marquee.sources.csv import list_data_files, read_csv_union
from marquee.sources.tables import ConstraintError, discard_refused, load_table
from marquee.sources.xml import read_xml_feed

META = "id,imdb_id,genres,original_title,title,budget,release_date,revenue,production_companies"


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def test_metadata_files_with_other_column_orders(spark, tmp_dir):
    write(f"{tmp_dir}/m/a.csv", META + "\n1,tt1,[],A,A,10,1995-10-30,5,[]\n")
    swapped = META.replace("budget", "X").replace("revenue", "budget").replace("X", "revenue")
    write(f"{tmp_dir}/m/deep/er/b.csv", swapped + "\n2,tt2,[],B,B,7,1995-10-30,70,[]\n")
    write(f"{tmp_dir}/m/_hidden/c.csv", META + "\n3,tt3,[],C,C,1,1995-10-30,1,[]\n")
    rows = {r.title: (r.budget, r.revenue) for r in J.stage_metadata(spark, f"{tmp_dir}/m").valid.collect()}
    assert rows == {"A": (10.0, 5.0), "B": (70.0, 7.0)}
    assert len(list_data_files(spark, f"{tmp_dir}/m")) == 2


def test_rows_with_wrong_cell_counts_are_rejects(spark, tmp_dir):
    write(f"{tmp_dir}/m.csv", META + "\n1,tt1,[],A,A,10,1995-10-30,5,[]\n2,tt2,[],B,B,10,1995-10-30,5,[],more\n3,tt3,[]\n")
    staged = J.stage_metadata(spark, f"{tmp_dir}/m.csv")
    assert [r.title for r in staged.valid.collect()] == ["A"]
    reasons = {r.raw_id: r.reject_reasons for r in staged.rejects.collect()}
    assert set(reasons) == {"2", "3"} and all("row:malformed" in r for r in reasons.values())


def test_missing_columns_take_their_defaults(spark, tmp_dir):
    write(f"{tmp_dir}/m.csv", "id,original_title,title,budget,revenue\n1,A,A,10,5\n")
    row = J.stage_metadata(spark, f"{tmp_dir}/m.csv").valid.first()
    assert (row.imdb_id, row.genres, row.release_date, row.production_companies) == (-9999, "[]", None, "[]")
    write(f"{tmp_dir}/n.csv", "id,title\n1,A\n")
    with pytest.raises(ValueError, match="original_title"):
        J.stage_metadata(spark, f"{tmp_dir}/n.csv")


def test_large_id_files_are_split(spark, tmp_dir):
    write(f"{tmp_dir}/links.csv", "movieId,imdbId,tmdbId\n" + "".join(f"{i},{i},{i}\n" for i in range(100_000)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "256k")
    try:
        df = read_csv_union(spark, f"{tmp_dir}/links.csv", K.MOVIE_LINKS.sources)
        assert df.rdd.getNumPartitions() > 4 and df.count() == 100_000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_rating_ids_beyond_int_are_rejects(spark, tmp_dir):
    write(f"{tmp_dir}/ratings.csv", "userId,movieId,rating,timestamp\n1,3000000000,5,1\n1,3000000001,1,1\n1,7,4,1\n1,7,x,1\n1,,3,1\n1,a,3,1\n")
    staged = J.stage_rating_rows(spark, f"{tmp_dir}/ratings.csv")
    assert sorted((r.movie_id, r.rating) for r in J.ratings_mean(staged.valid).collect()) == [(7, 4.0)]
    got = sorted((str(r.raw_movie_id), r.reject_reasons[0]) for r in staged.rejects.collect())
    assert got == [("3000000000", "movie_id:out_of_range"), ("3000000001", "movie_id:out_of_range"),
                   ("None", "movie_id:null"), ("a", "movie_id:not_integer")]


def test_films_that_differ_in_one_key_stay_two(spark, tmp_dir):
    row = "1,tt1,\"[{'id': 1, 'name': 'a'%s}]\",A,A,10,1995-10-30,5,[]\n"
    write(f"{tmp_dir}/m.csv", META + "\n" + row % "" + row % ", 'x': 1" + row % "")
    assert J.stage_metadata(spark, f"{tmp_dir}/m.csv").valid.count() == 2


def test_huge_amounts_do_not_abort(spark, tmp_dir):
    write(f"{tmp_dir}/m.csv", META + "\n1,1,[],A,A,1000000000000000000000,1995-10-30,5,[]\n2,2,[],B,B,10,1995-10-30,5,[]\n")
    staged = J.stage_metadata(spark, f"{tmp_dir}/m.csv")
    assert staged.rejects.first().reject_reasons == ["budget:out_of_range"]
    movies = spark.createDataFrame([(1, 1, "A", 1e30, None, 1.0, "[]", 3.0), (2, 2, "B", 10.0, None, 5.0, "[]", 3.0)],
                                   "movie_id int, imdb_id int, title string, budget double, release_date date, revenue double, "
                                   "production_companies string, rating double")
    feed = spark.createDataFrame([("A", "u", "a"), ("B", "u", "b")], "title string, wiki_url string, wiki_abstract string")
    assert {r.title for r in J.top_movies(movies, feed, 1).collect()} == {"B"}


FEED = "<feed>" + "".join(f"<doc><title>t{i}</title><url>u</url><abstract>a</abstract></doc>" for i in range(2000)) + "</feed>"


def test_gzip_feed_is_spread(spark, tmp_dir):
    with gzip.open(f"{tmp_dir}/feed.xml.gz", "wt") as f:
        f.write(FEED)
    df = read_xml_feed(spark, f"{tmp_dir}/feed.xml.gz")
    assert df.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
    assert df.select("title").distinct().count() == 2000


def test_record_end_inside_cdata_is_read(spark, tmp_dir):
    write(f"{tmp_dir}/f.xml", "<feed><doc><title>a</title><url>u</url><abstract><![CDATA[x </doc> y]]></abstract></doc>"
                              "<doc><title>b</title><url>u</url><abstract><![CDATA[fine]]></abstract></doc></feed>")
    for split in (True, False):
        got = read_xml_feed(spark, f"{tmp_dir}/f.xml", split=split).collect()
        assert sorted(r.abstract for r in got) == ["fine", "x </doc> y"]


def test_unreadable_records_are_rejects(spark, tmp_dir):
    write(f"{tmp_dir}/f.xml", "<feed><doc><title>a</title><url>u</url><abstract>x</abstract></doc><doc><title>b</url></doc></feed>")
    assert [r.title for r in J.read_clean_feed(spark, f"{tmp_dir}/f.xml").collect()] == ["a"]
    bad = J.feed_rejects(spark, f"{tmp_dir}/f.xml").collect()
    assert [r.raw_record for r in bad] == ["<doc><title>b</url></doc>"] and bad[0].reject_reasons == ["record:unreadable"]


def test_load_publishes_the_checked_copy(spark, tmp_dir):
    path = f"{tmp_dir}/t"
    rows = lambda *ids: spark.createDataFrame([(i, i, i) for i in ids], "movie_id int, imdb_id int, tmdb_id int")
    load_table(spark, rows(1, 2), path, K.MOVIE_LINKS)
    load_table(spark, rows(3), path, K.MOVIE_LINKS)
    with pytest.raises(ConstraintError) as e:
        load_table(spark, rows(2, 4), path, K.MOVIE_LINKS)
    assert e.value.violations.count() > 0
    discard_refused(spark, e.value)
    with pytest.raises(ConstraintError):
        load_table(spark, rows(5, 5), path, K.MOVIE_LINKS, mode="overwrite")
    assert sorted(r.movie_id for r in spark.read.parquet(path).collect()) == [1, 2, 3]
    load_table(spark, rows(9), path, K.MOVIE_LINKS, mode="overwrite")
    assert [r.movie_id for r in spark.read.parquet(path).collect()] == [9]
    assert not [d for d in os.listdir(tmp_dir) if d.endswith("-old")]


def ids(spark, *values):
    return spark.createDataFrame([(i, i, i) for i in values], "movie_id int, imdb_id int, tmdb_id int")


def test_append_reads_keys_and_no_data(spark, tmp_dir):
    """An append looks keys up in the index: only the parts of the batch's
    keys, and none of the table's files."""
    path = f"{tmp_dir}/t"
    load_table(spark, ids(spark, *range(500)), path, K.MOVIE_LINKS)
    new = ids(spark, 7, 9000)
    keys = session.materialize(tables._indexed(new, K.MOVIE_LINKS), "batch")
    found = tables.append_violations(spark, new, keys, path, K.MOVIE_LINKS)
    read = found.inputFiles()
    assert any(f"{path}__keys/" in f for f in read) and not any(f"{path}/" in f for f in read)
    assert "PartitionFilters: [part" in tables.known_keys(spark, path, keys)._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert {(r.constraint, r.key, r.num_rows) for r in found.collect()} == {
        ("primary_key_duplicate", "7|7", 2), ("unique:movie_id", "7", 2), ("unique:movie_id,imdb_id,tmdb_id", "7|7|7", 2)}


def test_index_that_is_behind_is_built_anew(spark, tmp_dir):
    path = f"{tmp_dir}/t"
    load_table(spark, ids(spark, 1, 2), path, K.MOVIE_LINKS)
    tables.write_table(ids(spark, 3), path, K.MOVIE_LINKS, mode="append")  # past the index
    with pytest.raises(ConstraintError):
        load_table(spark, ids(spark, 3), path, K.MOVIE_LINKS)
    load_table(spark, ids(spark, 4), path, K.MOVIE_LINKS)
    with pytest.raises(ConstraintError):
        load_table(spark, ids(spark, 4, 5), path, K.MOVIE_LINKS)
    assert sorted(r.movie_id for r in spark.read.parquet(path).collect()) == [1, 2, 3, 4]


def test_failed_overwrite_leaves_the_old_table(spark, tmp_dir):
    path = f"{tmp_dir}/deep/er/t"
    tables.write_table(spark.range(3), path)
    bad = F.when(F.col("id") == 4, F.raise_error(F.lit("no luck")).cast("long")).otherwise(F.col("id"))
    with pytest.raises(Exception, match="no luck"):
        tables.write_table(spark.range(5).select(bad.alias("id")), path)
    assert spark.read.parquet(path).count() == 3
    tables.write_table(spark.read.parquet(path).filter("id > 0"), path)  # a table may be replaced by what is read from it
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == [1, 2]
    assert os.listdir(f"{tmp_dir}/deep/er") == ["t"]


def test_constraints_take_one_shuffle(spark):
    rows = spark.createDataFrame([(1, 1, 1), (1, 2, 3), (2, 2, 2), (None, 4, 4), (2, 2, 2)], "movie_id int, imdb_id int, tmdb_id int")
    counted = quality.key_rows(rows, K.MOVIE_LINKS, text=False).groupBy("constraint", "h1", "h2").count()
    assert counted._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    got = {(r.constraint, r.key, r.num_rows) for r in quality.constraint_violations(rows, K.MOVIE_LINKS).collect()}
    assert got == {("primary_key_null", "NULL|4", 1), ("primary_key_duplicate", "2|2", 2), ("unique:movie_id", "1", 2),
                   ("unique:movie_id", "2", 2), ("unique:movie_id,imdb_id,tmdb_id", "2|2|2", 2)}


@pytest.mark.parametrize("descending", [True, False])
@pytest.mark.parametrize("kind", ["bigint", "decimal(20,3)", "string", "double"])
def test_top_k_with_a_bound(spark, descending, kind):
    n = 60 * BOUND_PARTS
    df = spark.range(3 * n).select(F.col("id").alias("r"), F.when(F.col("id") % 97 > 0, (F.col("id") * 7919) % n).cast(kind).alias("v"))
    key = lambda d: sorted((r.r, r.k) for r in d.collect())
    assert key(dense_top_k(df, "v", 25, descending, "k")) == key(dense_top_k_window(df, "v", 25, descending, "k"))


def test_no_local_folder_on_a_cluster(monkeypatch):
    class Context:
        master = "spark://somewhere:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return {}

    class Session:
        sparkContext = Context()
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(Session())


def test_staged_folders_can_be_dropped(spark):
    kept = session.materialize(spark.range(3), "drop-me")
    path = kept.inputFiles()[0]
    assert session.path_exists(spark, path)
    folder = path.rsplit("/", 1)[0]
    session.delete_path(spark, folder)
    assert not session.path_exists(spark, folder)


def test_fingerprint_follows_the_files(spark, tmp_dir):
    write(f"{tmp_dir}/a/x.csv", "1")
    one = session.fingerprint(spark, [f"{tmp_dir}/a"])
    assert one == session.fingerprint(spark, [f"{tmp_dir}/a"])
    write(f"{tmp_dir}/a/sub/y.csv", "22")
    assert one != session.fingerprint(spark, [f"{tmp_dir}/a"])


def test_run_all_leaves_no_copies_and_exports_csv(spark, tmp_dir):
    write(f"{tmp_dir}/in/meta.csv", META + "\n862,tt1,[],A,A,10,1995-10-30,5,[]\nx,tt1,[],A,A,10,1995-10-30,5,[]\n")
    write(f"{tmp_dir}/in/links.csv", "movieId,imdbId,tmdbId\n1,1,862\n")
    write(f"{tmp_dir}/in/ratings.csv", "userId,movieId,rating,timestamp\n1,1,4.0,1\n1,3000000000,4.0,1\n")
    write(f"{tmp_dir}/in/feed.xml", "<feed><doc><title>Wikipedia: A</title><url>u</url><abstract>a</abstract></doc></feed>")
    t = J.run_all(spark, f"{tmp_dir}/out", metadata_csv=f"{tmp_dir}/in/meta.csv", link_csvs=[f"{tmp_dir}/in/links.csv"],
                  ratings_glob=f"{tmp_dir}/in/ratings*.csv", feed_xml=f"{tmp_dir}/in/feed.xml", csv_dir=f"{tmp_dir}/csv")
    assert t.top.count() == 1 and t.metadata_rejects.count() == 1 and t.rating_rejects.count() == 1
    assert t.feed_rejects.count() == 0 and not os.path.exists(f"{tmp_dir}/out/_annotated")
    assert spark.read.option("header", True).csv(f"{tmp_dir}/csv/top_movies").first()["title"] == "A"


def test_package_is_shipped(tmp_dir):
    """The list UDF in a process that starts elsewhere and whose workers don't
    have the repository on their path."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = f"""
import sys
sys.path.insert(0, {root!r})
from pyspark.sql import functions as F
from marquee.session import local_session, ship_package
from marquee.functions.jsoncols import with_json_lists
spark = local_session(1)
ship_package(spark)
ship_package(spark)
df = spark.createDataFrame([("[{{'id': None}}]",)], "v string")
print("GOT", with_json_lists(df, [(F.col("v"), "j", "[]", "g")]).first().j)
spark.stop()
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_dir, env=env, capture_output=True, text=True, timeout=180)
    assert 'GOT [{"id":null}]' in out.stdout, out.stderr[-2000:]


def test_rating_files_are_folded_in_once(spark, tmp_dir):
    head = "userId,movieId,rating,timestamp\n"
    write(f"{tmp_dir}/r/a.csv", head + "1,1,0.1,1\n1,1,0.2,1\n1,2,x,1\n1,3000000000,5,1\n")
    write(f"{tmp_dir}/r/b.csv", head + "1,1,3.45,1\n1,3,4,1\n")
    state = f"{tmp_dir}/state"
    means = lambda df: sorted((r.movie_id, r.rating) for r in df.collect())
    assert means(J.fold_ratings(spark, state, f"{tmp_dir}/r/a.csv")) == [(1, 0.2), (2, None)]
    want = [(1, 1.3), (2, None), (3, 4.0)]
    for paths in (f"{tmp_dir}/r/b.csv", f"{tmp_dir}/r", [f"{tmp_dir}/r/a.csv", f"{tmp_dir}/r/b.csv"]):
        assert means(J.fold_ratings(spark, state, paths)) == want
    assert means(J.stage_ratings(spark, f"{tmp_dir}/r/*.csv")) == want
    write(f"{tmp_dir}/r/b.csv", head + "1,1,3.45,1\n1,3,4,1\n1,3,1,1\n")
    with pytest.raises(ValueError, match="was counted"):
        J.fold_ratings(spark, state, f"{tmp_dir}/r")
    write(f"{tmp_dir}/r/c.csv", head + "1,2,5,1\n")
    assert means(J.fold_ratings(spark, state, f"{tmp_dir}/r/c.csv")) == [(1, 1.3), (2, 5.0), (3, 4.0)]
    assert means(J.fold_ratings(spark, f"{tmp_dir}/none", f"{tmp_dir}/nothing")) == []


def test_rejects_tell_their_file_and_place(spark, tmp_dir):
    name = f"{tmp_dir}/m/a b+1%20.csv"
    write(name, META + "\n1,tt1,[],A,A,10,1995-10-30,5,[]\nx,tt1,\"[]\n\",A,A,10,1995-10-30,5,[]\n")
    write(f"{tmp_dir}/m/b.csv", META + "\ny,tt1,[],A,A,10,1995-10-30,5,[]\n")
    got = {r.raw_id: (r.file, r.block) for r in J.stage_metadata(spark, f"{tmp_dir}/m").rejects.collect()}
    assert got == {"x": (f"file:{name}", 0), "y": (f"file:{tmp_dir}/m/b.csv", 0)}
    write(f"{tmp_dir}/l/a b+1%20.csv", "movieId,imdbId,tmdbId\n1,1,x\n")
    assert [(r.file, r.block) for r in J.stage_links(spark, f"{tmp_dir}/l").rejects.collect()] == [(f"file:{tmp_dir}/l/a b+1%20.csv", 0)]
    write(f"{tmp_dir}/f.xml", "<feed><doc><title>b</url></doc></feed>")
    assert [r.file for r in J.feed_rejects(spark, f"{tmp_dir}/f.xml").collect()] == [f"file:{tmp_dir}/f.xml"]
