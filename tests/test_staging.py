"""What a query writes before its own work, and what a first load keeps."""

import os

from pyspark.sql import functions as F

from marquee import contracts as K
from marquee import session
from marquee.functions.jsoncols import _literal_list_to_json, with_json_lists
from marquee.operators.quality import constraint_violations
from marquee.plans import catalog as C
from marquee.plans import standins as S
from marquee.sources import tables
from marquee.sources.tables import load_table

SF = "/root/testdata/sf0.001"


def folder(tmp_dir):
    """The driver folder under another path, so that nothing is staged for it."""
    for t in os.listdir(SF):
        os.symlink(f"{SF}/{t}", f"{tmp_dir}/{t}")
    return tmp_dir


def names(path):
    return {n for n in os.listdir(path.removeprefix("file:")) if not n.startswith(("_", "."))}


def test_a_query_stages_the_inputs_it_reads(spark, tmp_dir):
    d = folder(tmp_dir)
    base = S.FilmFiles(spark, d).base
    got = C.queries()["csv_folded_mean"](spark, d)
    assert names(base) == {"ratings", "ratings_small"}
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, C.queries()["csv_glob_union_mean"](spark, d).collect()))
    C.queries()["table_checked_load"](spark, d)
    assert names(base) == {"ratings", "ratings_small", "links", "links_small"}


def test_a_query_loads_the_tables_it_reads(spark, tmp_dir):
    d = folder(tmp_dir)
    C.queries()["constraint_violations"](spark, d)
    out = session.staging_dir(spark, "film-tables", key=S.inputs_key(spark, d))
    assert names(out) == {"movie_links", "movies_metadata", "movie_ratings", "quarantine"}
    assert "feed_xml" not in names(S.FilmFiles(spark, d).base)
    t = C.film_tables(spark, d)  # the rest of E6; what is there is not written again
    assert t.feed.count() > 0 and t.top.count() > 0 and names(out) > {"wiki_feed", "top_movies"}
    whole = C.film_tables(spark, SF)
    for name in ("links", "metadata", "ratings", "feed", "top", "link_rejects", "metadata_rejects", "rating_rejects"):
        a, b = (sorted(repr(r) for r in getattr(x, name).drop("file", "block").collect()) for x in (t, whole))
        assert a == b, name


def test_plain_lists_are_read_by_their_pattern(spark):
    texts = ["[]", " [ \t] ", "[{'id': 1, 'name': 'a'}]", "\n[ { 'name' : \"b c\" ,\t\"id\":-20 } , {'id':0,'name':''}\n]\r\n",
             "[{'id': 1, 'name': 'é 日本 $1 /'}, {\"name\": 'x, y', 'id': 123456789012345678}]", "[{'id': 1, 'name': '{[]}, :'}]",
             "[{'id': 1, 'name': 'a'} {'id': 2, 'name': 'b'}]", "[{'id': 1, 'name': 'a'},]", "[,]", "[{'id': 01, 'name': 'a'}]",
             "[[{'id': 1, 'name': 'a'}]]", "[{'id': 1, 'name': 'a'}", "[{'id': 1, 'name': 'a'}]]", "[{'id': 1, 'name': 'a\x01b'}]",
             "[" + "-" * 7000 + "1]", "[{'id': 1, 'name': 'a\\'b'}]", "{'id': 1, 'name': 'a'}"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    out = with_json_lists(df, [(F.col("t"), "j", "[]", "g")])
    assert "LongType" not in out._jdf.queryExecution().executedPlan().toString()  # no list of structs is made
    assert {r.t: r.j for r in out.collect()} == {t: _literal_list_to_json(t)[0] for t in texts}


def test_first_load_keeps_narrow_keys(spark, tmp_dir):
    """A first load writes its keys once, into the index, without what the
    index is not asked for; an index of another shape is built anew."""
    root = f"{session.ensure_checkpoint_dir(spark)}/marquee-staging".removeprefix("file:")
    before = {n for n in os.listdir(root) if n.startswith("batch-keys")} if os.path.isdir(root) else set()
    rows = lambda *ids: spark.createDataFrame([(i, i, i) for i in ids], "movie_id int, imdb_id int, tmdb_id int")
    path = f"{tmp_dir}/t"
    load_table(spark, rows(1, 2), path, K.MOVIE_LINKS)
    assert {n for n in os.listdir(root) if n.startswith("batch-keys")} == before
    index = spark.read.parquet(tables.key_index(path))
    assert index.columns == ["constraint", "h1", "exact", "part"] and index.count() == 6
    tables._indexed(rows(1, 2), K.MOVIE_LINKS).withColumn("exact", F.lit("{}")).write.mode("overwrite") \
        .partitionBy("part").parquet(tables.key_index(path))  # as an earlier version left it
    try:
        load_table(spark, rows(2), path, K.MOVIE_LINKS)
    except tables.ConstraintError as e:
        assert e.violations.count() == 3
    else:
        raise AssertionError("loaded twice")


def test_keys_are_counted_by_one_hash(spark):
    rows = spark.createDataFrame([(1, 1, 1), (2, 2, 2), (2, 3, 4), (None, 5, 5)], "movie_id int, imdb_id int, tmdb_id int")
    got = sorted(map(tuple, constraint_violations(rows, K.MOVIE_LINKS).collect()))
    assert got == [("primary_key_null", "NULL|5", 1), ("unique:movie_id", "2", 2)]
