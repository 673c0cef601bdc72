"""Registered queries against SQL, and the pipeline against plain Python."""

import hashlib
import zlib

import duckdb
import numpy as np
import pytest
import test_jaccard
import test_lines
import test_repeats

import corpus_pipeline
from tokenizers import Tokenizer
from marquee.llm import bpe, queries, token_files

SF = "/root/testdata/sf0.001"
TABLES = ("documents", "embeddings", "benchmark", "conversations")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_matches_sql(spark, duck, name):
    df = queries.queries()[name](spark, SF)
    cur = duck.execute(queries.oracle_sql()[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == sorted(df.columns)
    got = sorted(tuple(r[c] for c in names) for r in df.collect())
    assert got == sorted(cur.fetchall())
    mine = {f.name: str(f.type) for f in df.toArrow().schema}
    theirs = {f.name: str(f.type) for f in duck.sql(queries.oracle_sql()[name]).to_arrow_table().schema}
    assert mine == theirs


@pytest.fixture(scope="module")
def documents(spark):
    return [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]


def test_names():
    found = queries.queries()
    assert sorted(int(n[2:].split("_")[0]) for n in found) == list(range(1, 11))


def test_jaccard_query(spark, documents):
    got = queries.queries()["op5_ngram_jaccard"](spark, SF)
    assert test_jaccard.result(got) == test_jaccard.plain(documents)


def test_repeats_query(spark, documents):
    got = queries.queries()["op6_suffix_repeats"](spark, SF)
    assert test_repeats.result(got) == test_repeats.plain(documents)


def test_token_queries(spark, documents):
    one = bpe.encoding(bpe.default_ranks(), bpe.default_pattern()).encode_ordinary
    got = {r["doc_id"]: r for r in queries.queries()["op4_byte_bpe"](spark, SF).collect()}
    files = {r["doc_id"]: r for r in queries.queries()["op9_token_files"](spark, SF).collect()}
    plain = Tokenizer.from_file(token_files.default_tokenizer())  # the plain call: nothing is set
    start = 0
    for i, t in sorted(documents):
        ids, other = one(t), plain.encode(t, add_special_tokens=False).ids
        assert got[i]["n_tokens"] == len(ids)
        assert got[i]["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert (files[i]["start"], files[i]["n_tokens"]) == (start, len(other) + 1)
        assert files[i]["ids_crc32"] == zlib.crc32(np.array([*other, 2], "<u4").tobytes())
        start += len(other) + 1


def test_leaks_query(spark, documents, duck):
    got = {(r["doc_id"], r["item_id"]) for r in queries.queries()["op8_decontamination"](spark, SF).collect()}
    want = set(duck.execute("SELECT doc_id, item_id FROM documents d JOIN benchmark b ON contains(d.text, b.text)").fetchall())
    assert want <= got


def test_pipeline_against_plain(spark, documents, duck):
    docs = [(i, t) for i, t in documents if any(c.isalpha() for c in t)]
    left = test_lines.plain(docs)
    docs = [(i, "\n".join(left[i])) for i, _ in docs if left[i]]
    component = {i: c for i, _, c in test_jaccard.plain(docs)}
    docs = [(i, t) for i, t in docs if component[str(i)] == str(i)]
    items = [[w.strip(".,").lower() for w in t.split()] for (t,) in duck.execute("SELECT text FROM benchmark").fetchall()]
    grams = lambda w: {tuple(w[k:k + 8]) for k in range(max(len(w) - 7, 1))}
    every = set().union(*map(grams, items))
    docs = [(i, t) for i, t in docs if not every & grams([w.strip(".,").lower() for w in t.split()])]
    one = bpe.encoding(bpe.default_ranks(), bpe.default_pattern()).encode_ordinary
    got = {r["doc_id"]: (r["n_tokens"], r["decoded_sha256"]) for r in corpus_pipeline.run(spark, SF).collect()}
    assert got == {i: (len(one(t)), hashlib.sha256(t.encode()).hexdigest()) for i, t in docs}


def test_stages_keep_the_columns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF).columns == docs.columns, name


def test_pipeline_stages_on_edges(spark):
    from helpers import EDGES, table
    extra = ("lang_pred", "score", "line_count", "content", "n", "rank", "ids")
    docs = table(spark, EDGES, extra=extra)
    left = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        left[name] = out.collect()
        if name != "encode":
            assert out.columns == docs.columns, name
            assert all(r[c] == "clash" for r in left[name] for c in extra)
        assert stage(spark, docs.limit(0), SF).collect() == []
    assert {r["doc_id"] for r in left["language"]} == {4, None, 5, 6, 7, 8, 9, 11}
    assert sorted(str(r["doc_id"]) for r in left["near_duplicates"]) == sorted(
        map(str, [1, 2, 3, 4, None, 5, 7, 9, 10, 11]))  # 6 and 8 are copies, 7 is there once
    assert len(left["encode"]) == len(EDGES)


def test_rows_with_null_and_repeated_ids_are_their_own(spark):
    """Decisions are about rows: a clean text stays whatever another row with
    its id (or without one) holds, and copies and passages go without an id."""
    from helpers import table
    item = spark.read.parquet(f"{SF}/benchmark.parquet").first()["text"]
    base = " ".join(f"word{i}" for i in range(60))
    near = base.replace("word30", "other")
    clean = " ".join(f"clean{i}" for i in range(40))
    docs = table(spark, [(1, base), (None, near), (None, near + " more"), (2, near), (2, clean), (None, None), (None, ""), (3, None)])
    kept = [(r["doc_id"], r["text"]) for r in corpus_pipeline.near_duplicates(spark, docs, SF).collect()]
    assert sorted(map(str, kept)) == sorted(map(str, [(1, base), (2, clean), (None, None), (None, ""), (3, None)]))
    docs = table(spark, [(None, clean + " " + item), (None, clean), (2, item), (2, clean), (None, None), (4, "")])
    kept = [(r["doc_id"], r["text"]) for r in corpus_pipeline.decontaminate(spark, docs, SF).collect()]
    assert sorted(map(str, kept)) == sorted(map(str, [(None, clean), (2, clean), (None, None), (4, "")]))
    docs = table(spark, [(None, "a\nb\nc"), (None, "a\nb\nd"), (7, "x\ny"), (7, "z"), (None, None)])
    kept = [(r["doc_id"], r["text"]) for r in corpus_pipeline.repeated_lines(spark, docs, SF).collect()]
    assert len(kept) == 5 and (7, "z") in kept and (None, None) in kept
