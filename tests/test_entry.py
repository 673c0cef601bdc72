"""Driver contract on sf0.001, and every registered query against its DuckDB oracle."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from marquee.plans import catalog
from marquee.sources.tables import DRIVER_TABLES

SF = "/root/testdata/sf0.001"


def test_entry_runs_with_stable_schema(spark):
    df = E.entry(spark)
    assert df.columns == ["movie_id", "imdb_id", "budget", "year", "revenue", "rating", "ratio"]
    assert df.count() > 0


def test_every_query_has_an_oracle():
    assert set(catalog.queries()) == set(catalog.oracle_sql())
    assert set(catalog.queries()) <= set(E.queries())


def _norm(v):
    if isinstance(v, float):
        return float(f"{v:.12g}") if not math.isnan(v) else "nan"
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in DRIVER_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF)
    cols = df.columns
    got = sorted((tuple(_norm(x) for x in r) for r in df.collect()), key=repr)
    cur = duck.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    assert sorted(cols) == sorted(dcols)
    idx = [dcols.index(c) for c in cols]
    want = sorted((tuple(_norm(r[i]) for i in idx) for r in cur.fetchall()), key=repr)
    assert got == want


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_query_types_match_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF)
    mine = {f.name: str(f.type) for f in df.toArrow().schema}
    theirs = {f.name: str(f.type) for f in duck.sql(E.oracle_sql()[name]).to_arrow_table().schema}
    assert mine == theirs


def test_entry_without_checkpoint_dir(tmp_path):
    """With no spark.checkpoint.dir configured, entry() sets a local one and runs."""
    import os
    import subprocess
    import sys
    conf_dir = tmp_path / "conf"
    conf_dir.mkdir()
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = ("import sys; sys.path.insert(0, %r)\n"
            "from pyspark.sql import SparkSession\n"
            "s = SparkSession.builder.master('local[2]').config('spark.ui.enabled', 'false')"
            ".getOrCreate()\n"
            "assert not s.sparkContext.getCheckpointDir()\n"
            "import __spark_entry__ as E\n"
            "print('ROWS', E.entry(s).count())\n") % repo
    env = dict(os.environ, SPARK_CONF_DIR=str(conf_dir))
    out = subprocess.run([sys.executable, "-c", code], env=env, capture_output=True, text=True,
                         timeout=600)
    assert "ROWS 1000" in out.stdout, out.stderr[-2000:]
