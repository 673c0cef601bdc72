"""What a pass over a feed or a CSV file computes for each record."""

import re

from pyspark.sql import functions as F

from marquee.plans import jobs as J
from marquee.sources import csv as C


def executed(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def write_feed(path: str) -> str:
    docs = [f"<doc><title>Wikipedia: Film {i}</title><url>u{i}</url><abstract>a<!-- x -->{i}</abstract></doc>" for i in range(20)]
    docs += ["<doc><title>Wikipedia: A &amp; B</title><url>v</url><abstract>b</abstract></doc>",
             "<doc><title><![CDATA[Wikipedia: C]]></title><url>w</url><abstract>c</abstract></doc>", "<doc><title>Wikipedia: broken</title><url></doc>"]
    with open(path, "w") as f:
        f.write("<feed>" + "".join(docs) + "</feed>")
    return path


def test_titles_are_computed_once(spark, tmp_path):
    """Filters on a record's text or title do not compute it again, and the
    records are read once, not again for titles that must be parsed."""
    feed = J.RawFeed.of(spark, write_feed(str(tmp_path / "f.xml")))
    plan = executed(feed.titles())
    assert not re.search(r"Filter .*(regexp_extract|substring_index|from_xml)\(", plan)
    assert plan.count("from_xml(") == 1
    assert {r.title for r in feed.titles().collect()} - {None} == {f"Film {i}" for i in range(20)} | {"A & B", "C", "broken"}


def test_entries_of_all_kinds_of_titles(spark, tmp_path):
    feed = J.RawFeed.of(spark, write_feed(str(tmp_path / "f.xml")))
    titles = spark.createDataFrame([("Film 3",), ("A & B",), ("C",), ("broken",), ("absent",)], "title string")
    found = sorted((r.title, r.wiki_url, r.wiki_abstract) for r in feed.entries(titles).collect())
    assert found == [("A & B", "v", "b"), ("C", "w", "c"), ("Film 3", "u3", "a3")]


def test_quote_codes_without_a_walk_in_lambdas(spark):
    codes = spark.range(1).select(F.lit('a,"b').alias("x")).select(C._quote_code(F.col("x")).alias("code"))
    assert "lambda" not in codes._jdf.queryExecution().analyzed().toString()
    long = ",".join(['"a ""b"" c"', "x"] * 20_000)
    rows = spark.createDataFrame([(long,), (long + ',"',), ('b"' + long,)], "x string")
    # bit 0: ends inside if it begins at a cell's start; bit 1: if it begins inside
    assert [r.code for r in rows.select(C._quote_code(F.col("x")).alias("code")).collect()] == [0, 3, 0]
