"""Records that reach over byte ranges, at every place where a file can be cut."""

import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from marquee.sources import csv as C
from marquee.sources import records
from marquee.sources import xml as X


@pytest.fixture()
def ranges_of(spark):
    """Sets the size of byte ranges, and small batches in tasks."""
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.execution.arrow.maxRecordsPerBatch")
    old = {k: spark.conf.get(k) for k in keys}

    def put(size, batch=3):
        for k, v in zip(keys, (size, 1, batch)):
            spark.conf.set(k, str(v))
    yield put
    for k, v in old.items():
        spark.conf.set(k, v)


CSV = ('a,b,c\n1,"x\ny",3\n"1\n\n""2"",\n",plain,"q""\nr"\n4,5\n"last, one\n",,""\n,"unquoted "" \n tail"x,7\n8,mid"dle,9')


def built_in(spark, path):
    schema = "a string, b string, c string, " + C.MALFORMED + " string"
    return spark.read.schema(schema).options(header=True, multiLine=True, quote='"', escape='"', columnPruning=False,
                                             columnNameOfCorruptRecord=C.MALFORMED).csv(path)


def rows(df):
    return sorted(repr(tuple(r)) for r in df.collect())


@pytest.mark.parametrize("newline", ["\n", "\r\n"])
def test_csv_cut_at_every_place(spark, tmp_dir, ranges_of, newline):
    text = CSV.replace("\n", newline) + newline
    with open(f"{tmp_dir}/f.csv", "w", newline="") as f:
        f.write(text)
    want = rows(built_in(spark, f"{tmp_dir}/f.csv"))
    for size in (5, 16, 1 << 20):
        ranges_of(size)
        got = C.read_csv_text(spark, f"{tmp_dir}/f.csv", null_tokens=False, malformed=True, partitions=1)
        assert rows(got) == want, size


def plain_records(text):
    """The rows of a CSV text: line breaks outside quotes end them."""
    out, own, quoted, start = [], "", False, True
    i = 0
    while i < len(text):
        c = text[i]
        if quoted:
            if text[i:i + 2] == '""':
                own, i = own + '""', i + 2
                continue
            quoted = c != '"'
            start = False
        elif c == '"' and start:
            quoted = True
        elif c == "\n":
            out.append(own)
            own, start, i = "", True, i + 1
            continue
        else:
            start = c == ","
        own, i = own + c, i + 1
    return [*out, own.removesuffix("\n")] if own else out


def cut_in_ranges(chunks, codes, states, sep, borders, batch):
    """The records of chunks in byte ranges (a border: a range begins there),
    as the two passes find them."""
    blocks, at = [], 0
    for i in range(len(chunks)):
        at += borders[i]
        blocks.append(at)

    def batches(**more):
        full = {"file": pa.array([1] * len(chunks)), "block": pa.array(blocks), "code": pa.array(codes, pa.int32()), **more}
        table = pa.RecordBatch.from_pydict(full)
        return [table.slice(i, batch) for i in range(0, len(chunks), batch)]

    found = pa.Table.from_batches(records._report(states)(batches())).to_pandas()
    ranges = records._combined(found).set_index("block")
    more = {"value": pa.array(chunks), "start": pa.array(ranges.start[blocks].astype("int32")), "owner": pa.array(ranges.owner[blocks])}
    whole = [(r["owner"], 0, r["first"], r["value"]) for b in records._cut(states, sep, False)(batches(**more)) for r in b.to_pylist()]
    parts = {}
    cut = pa.array(ranges.cut[blocks])
    for b in records._cut(states, sep, True)([x.filter(cut.slice(i * batch, batch)) for i, x in enumerate(batches(**more))]):
        for r in b.to_pylist():
            parts.setdefault(r["owner"], []).append((r["block"], r["first"], r["value"]))
    joined = [(o, 1, any(f for _, f, _ in p), sep.join(v for _, _, v in sorted(p))) for o, p in parts.items()]
    return [(f, v) for _, _, f, v in sorted(whole, key=lambda r: r[:2]) + joined], len(joined)


def test_all_places_of_cuts(spark):
    """Every way to deal up to eight lines to ranges, in batches of any size."""
    rng = random.Random(7)
    texts = ["".join(rng.choice('ab,,""\n\n\n') for _ in range(24)).strip("\n") for _ in range(14)]
    lines = [t.split("\n")[:8] for t in texts]
    df = spark.createDataFrame([(i, j, x) for i, own in enumerate(lines) for j, x in enumerate(own)], "i int, j int, x string")
    codes = {(r.i, r.j): r.code for r in df.select("i", "j", C._quote_code(F.col("x")).alias("code")).collect()}
    spanning = 0
    for i, own in enumerate(lines):
        want = plain_records("\n".join(own) + "\n")
        for mask in range(1 << (len(own) - 1)):
            borders = [0, *[mask >> k & 1 for k in range(len(own) - 1)]]
            for batch in (1, 3, 8):
                got, n = cut_in_ranges(own, [codes[i, j] for j in range(len(own))], 2, "\n", borders, batch)
                assert sorted(v for _, v in got) == sorted(want), (own, borders, batch)
                assert [v for f, v in got if f] == want[:1]
                spanning += n
    assert spanning > 100


def test_quote_states_against_a_walk(spark, tmp_dir, ranges_of):
    rng = random.Random(7)
    text = "".join(rng.choice('ab,,""\n\n') for _ in range(400)).lstrip("\n")
    with open(f"{tmp_dir}/f.csv", "w") as f:
        f.write(text)
    for size in (7, 100):
        ranges_of(size, 2)
        found, _ = records.joined_records(spark, [f"{tmp_dir}/f.csv"], "\n", 2, C._quote_code)
        assert sorted(r.value for r in found.collect()) == sorted(plain_records(text)), (text, size)
        assert [r.value for r in found.filter("first").collect()] == plain_records(text)[:1]


def test_more_ranges_than_fit_a_broadcast(spark, tmp_dir, ranges_of):
    paths = []
    for i in range(5):
        paths.append(f"{tmp_dir}/{i}.csv")
        with open(paths[-1], "w") as f:
            f.write(CSV)
    ranges_of(10)
    one, n = records.joined_records(spark, paths, "\n", 2, C._quote_code)
    many, m = records.joined_records(spark, paths, "\n", 2, C._quote_code, max_bytes=records.RANGE_BYTES)
    assert n == m > 5 and rows(one.select("first", "value")) == rows(many.select("first", "value"))


def test_one_large_file_with_line_breaks_is_read_by_many_tasks(spark, tmp_dir, ranges_of):
    with open(f"{tmp_dir}/f.csv", "w") as f:
        f.write("id,text\n" + "".join(f'{i},"line {i}\nwith a break\n\nand ""quotes"", {i}"\n' for i in range(40_000)))
    ranges_of("128k", 10_000)
    df = C.read_csv_text(spark, f"{tmp_dir}/f.csv", ["id", "text"])
    assert df.rdd.getNumPartitions() > 8
    assert df.count() == df.select("id").distinct().count() == 40_000
    assert df.filter(F.col("text") == F.concat(F.lit("line "), "id", F.lit('\nwith a break\n\nand "quotes", '), "id")).count() == 40_000


def test_empty_and_header_only_files(spark, tmp_dir):
    for name, text in (("a", "id,t\n"), ("b", ""), ("c", "id,t"), ("d", "id,t\n1,x"), ("e", "id,t\n\n\n2,y\n\n")):
        with open(f"{tmp_dir}/{name}.csv", "w") as f:
            f.write(text)
    assert sorted(tuple(r) for r in C.read_csv_text(spark, tmp_dir).collect()) == [("1", "x"), ("2", "y")]


FEED = ("<?xml version='1.0'?><!-- <doc> no row </doc> --><feed>\n"
        "<doc><title>a</title><url>u</url><abstract><![CDATA[x </doc> <!-- y ]]]]><![CDATA[> z]]></abstract></doc>"
        "<doc><title>b<!-- </doc> <![CDATA[ --></title><url>u</url><abstract>--&gt; &lt;/doc&gt; ]] &gt;</abstract></doc>"
        "<!-- <doc>x</doc><doc>y</doc> --><doc><title>c</title><?pi </doc> ?><url>u</url><abstract><![CDATA[</doc></doc>]]></abstract></doc>\n"
        "<!----><doc><title>d</title><url>u</url><abstract>é -- <![CDATA[<?]]> end</abstract></doc>\n</feed>\n")


def test_feed_cut_at_every_place(spark, tmp_dir, ranges_of):
    with open(f"{tmp_dir}/f.xml", "w") as f:
        f.write(FEED)
    want = [("a", "u", "x </doc> <!-- y ]]> z"), ("b", "u", "--> </doc> ]] >"), ("c", "u", "</doc></doc>"), ("d", "u", "é -- <? end")]
    for size in (9, 40, 1 << 20):
        ranges_of(size)
        got = X.read_xml_feed(spark, f"{tmp_dir}/f.xml", partitions=1)
        assert sorted(tuple(r) for r in got.collect()) == want, size


def test_sections_within_marks(spark):
    """Marks that overlap: what closes a comment may lie within what opens one."""
    texts = {"<!-->": 2, "<!--->": 2, "<!---->": 0, "<!-- <!-->": 0, "<!-- <!--->": 0, "<? <?>": 0, "<?>": 3, "]]>": 0, "<![CDATA[ --> ?>": 1,
             "<![CDATA[ <!-- ]]]>": 0, "-->": 0, "<!-- ]]> ?>": 2, "<!-- a --><![CDATA[": 1}
    df = spark.createDataFrame(list(texts.items()), "t string, want int").select("*", (X._section_code(F.col("t")) % 4).alias("got"))
    assert [(r.t, r.got) for r in df.collect() if r.got != r.want] == []
