"""Plan shape guards: the properties the scale design relies on."""

from marquee import contracts as K
from marquee.operators.clean import apply_contract
from marquee.plans import catalog as C


def executed(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_cleaning_runs_python_once(spark):
    raw = spark.createDataFrame([("1", "tt1", "[]", "a", "a", "1", "2000-01-01", "2", "[]")],
                                ", ".join(f"`{c}` string" for c in K.MOVIES_METADATA.sources))
    c = apply_contract(raw, K.MOVIES_METADATA)
    assert executed(c.valid).count("ArrowEvalPython") == 1
    assert executed(c.rejects).count("ArrowEvalPython") == 1


def test_flagship_scans_lineitem_once(spark):
    df = C.top_ratio_dense_rank(spark, "/root/testdata/sf0.001")
    plan = executed(df)
    # the per-film aggregate is materialized; only the checkpoint is read twice
    assert "lineitem" not in plan
    assert "TakeOrderedAndProject" in plan  # per-task top-k, one merge of <= k * tasks values


def test_top_movies_streams_the_feed(spark):
    df = C.top_movies(spark, "/root/testdata/sf0.001")
    plan = executed(df)
    assert "SortMergeJoin" not in plan  # winners measured small -> broadcast
    assert "BroadcastHashJoin" in plan and "wiki_abstract" in plan
