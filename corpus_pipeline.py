"""A training-corpus pipeline over ``documents``.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is
written and read again as the next stage's input.  All but the last return the
columns of their input, which has those of ``documents``; further columns are
carried along whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.llm import bpe, decontam, jaccard, langid, lines
from marquee.operators.joins import join_small_side
from marquee.session import delete_path, materialize, staged_tables


COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _carried(docs: DataFrame) -> DataFrame:
    """``docs`` with names for its further columns that no operator uses."""
    return docs.toDF(*[c if c in COLUMNS else f"__further_{i}" for i, c in enumerate(docs.columns)])


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language; those without any (no text, or no letter in
    it) go.  Learned from the labelled documents themselves."""
    model = langid.fit(docs.select("text", "lang"))
    own = _carried(docs)
    kept = langid.predict(own, model).filter(F.col("lang_pred") != langid.UNKNOWN)
    return kept.select(*own.columns).toDF(*docs.columns)


def repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without later copies of repeated runs of lines; those of
    which no line is left go."""
    own = _carried(docs)
    out = lines.dedup_lines(own)
    out = out.filter((F.col("line_count") == 0) | (F.col("removed_lines") < F.col("line_count")))
    return out.withColumn("n_chars", F.when(F.col("removed_lines") > 0, F.length("text").cast("long"))
                          .otherwise(F.col("n_chars"))).select(*own.columns).toDF(*docs.columns)


def told_apart(docs: DataFrame) -> DataFrame:
    """``docs`` with a number ``row_`` of each row, as a table: rows with a
    null or repeated id are their own."""
    return materialize(_carried(docs).withColumn("row_", F.monotonically_increasing_id()), "pipeline-rows")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the
    smallest id (a null id comes last), and of those the first in the table
    (by a hash of the text first).  Null and empty texts are no copies.  Ids
    may be null or repeated.  Texts are joined with the rows of groups only."""
    rows = told_apart(docs)
    with staged_tables() as made:
        groups = jaccard.near_duplicates(rows.select("row_", "text"), id_col="row_").filter("doc_id <> component_id")
        groups = materialize(groups.select(F.col("doc_id").alias("row_"), "component_id"), "pipeline-groups")
        members = materialize(groups.unionByName(groups.select(F.col("component_id").alias("row_"), "component_id").distinct()), "pipeline-members")
        keys = join_small_side(rows.select("row_", "doc_id", "text"), members, "row_")
        order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", F.xxhash64("text").alias("hash"), "row_")
        keys = materialize(keys.select("component_id", "row_", order.alias("key")), "pipeline-keys")
        first = keys.groupBy("component_id").agg(F.min("key").alias("first"))
        others = keys.join(first, "component_id").filter(F.col("row_") != F.col("first.row_")).select("row_")
    others = materialize(others, "pipeline-copies")
    for path in made:
        delete_path(spark, path)
    return join_small_side(rows, others, "row_", "left_anti").drop("row_").toDF(*docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of the benchmark.  A row goes for its own
    text only, whatever its id; ids may be null or repeated."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text")
    rows = told_apart(docs)
    with staged_tables() as made:
        leaks = decontam.find_leaks(rows.select(F.col("row_").alias("doc_id"), "text"), benchmark)
    leaks = materialize(leaks.select(F.col("doc_id").alias("row_")).distinct(), "pipeline-leaks")
    for path in made:
        delete_path(spark, path)
    return join_small_side(rows, leaks, "row_", "left_anti").drop("row_").toDF(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' token ids, counted and hashed, and decoded again; one row
    for each row, null texts as empty ones, null and repeated ids as they are."""
    return bpe.encode_documents(docs).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


STAGES = [
    ("language", language),
    ("repeated_lines", repeated_lines),
    ("near_duplicates", near_duplicates),
    ("decontaminate", decontaminate),
    ("encode", encode),
]

#: SQL has no counterpart of the language model and the encoder; tests hold
#: the pipeline against a plain version in Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's table.  A stage's input and the tables that it made on
    its way are deleted when its output is written."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for name, stage in STAGES:
        with staged_tables() as made:
            out = stage(spark, docs, sf_dir)
        with staged_tables() as written:
            docs = materialize(out, f"pipeline-{name}")
        for path in [*before, *made]:
            delete_path(spark, path)
        before = written
    return docs
