"""What the pipeline leaves on disk and what it joins texts with."""

import glob
import random
import time

import corpus_pipeline
from helpers import table
from test_queries import SF

from marquee.session import CLEANUP_CONF, ensure_checkpoint_dir, materialize


def _shuffle_files(spark) -> int:
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return sum(files.apply(i).getName().startswith("shuffle_") for i in range(files.size()))


def test_a_written_table_leaves_no_shuffle_files(spark):
    before = _shuffle_files(spark)
    out = materialize(spark.range(10_000).selectExpr("id % 7 AS k").repartition(5).groupBy("k").count(), "no-shuffle-left")
    for _ in range(50):
        if _shuffle_files(spark) <= before:
            break
        time.sleep(0.1)
    assert _shuffle_files(spark) <= before and out.count() == 7
    assert spark.conf.get(CLEANUP_CONF, "false") == "false"


def test_the_pipeline_leaves_its_last_table_only(spark):
    folder = ensure_checkpoint_dir(spark).removeprefix("file:") + "/marquee-staging/*"
    before = set(glob.glob(folder))
    out = corpus_pipeline.run(spark, SF)
    left = set(glob.glob(folder)) - before
    assert len(left) == 1 and "/pipeline-encode-" in left.pop() and out.count() > 0


def test_texts_are_joined_with_the_rows_of_groups_only(spark, monkeypatch):
    """At size, a join of all texts with a row for each document shuffles them."""
    sizes, own = [], corpus_pipeline.join_small_side

    def joined(big, small, *how):
        sizes.append(small.count())
        return own(big, small, *how)
    monkeypatch.setattr(corpus_pipeline, "join_small_side", joined)
    rng = random.Random(2)
    rows = [(90 - i, " ".join("w%x" % rng.getrandbits(40) for _ in range(60))) for i in range(60)]
    rows += [(3, rows[0][1]), (None, rows[1][1]), (95, rows[2][1] + " more"), (rows[3][0], rows[3][1])]
    docs = table(spark, rows).repartition(3)
    kept = sorted((str(r["doc_id"]), r["text"]) for r in corpus_pipeline.near_duplicates(spark, docs, SF).collect())
    assert kept == sorted((str(i), t) for i, t in rows[1:61])
    corpus_pipeline.decontaminate(spark, docs, SF).collect()
    assert sizes and max(sizes) < 10, sizes


def test_looking_for_passages_in_a_batch_is_bounded():
    import tracemalloc

    import numpy as np
    import pyarrow as pa

    from marquee.llm import decontam
    from marquee.llm.text_arrow import slices
    rng = random.Random(3)
    words = ["w%d" % i for i in range(500)]
    batch = pa.RecordBatch.from_pydict({"id": list(range(2000)), "text": [" ".join(rng.choices(words, k=400)) for _ in range(2000)]})
    found = decontam.Words()
    tracemalloc.start()
    for own in slices(iter([batch]), "text", decontam.SLICE_BYTES):
        list(decontam._rows(found, own, [8], False, lambda h: np.zeros(len(h), bool)))
    _, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert peak < 40 << 20
