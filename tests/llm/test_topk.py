import math
import random

import numpy as np
import pytest

from marquee.llm import topk


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")


def plain(rows, k, every=1):
    own = [(i, [math.floor(1024 * float(np.float32(x))) for x in v]) for i, v, _ in rows
           if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = set()
    for i, q in {(i, tuple(v)) for i, v in own if i % every == 0}:
        scores = sorted((-sum(a * b for a, b in zip(q, c)), j) for j, c in own if j != i and len(c) == len(q))[:k]
        out |= {(i, r + 1, j, -s) for r, (s, j) in enumerate(scores)}
    return out


def result(spark, rows, k, every=1, **options):
    vectors = topk.integer_vectors(frame(spark, rows), "vec_id", "embedding")
    return set(map(tuple, topk.top_k(vectors.filter(f"vec_id % {every} = 0"), vectors, k, **options).collect()))


@pytest.mark.parametrize("spread", [0.0, 1.5])
def test_against_plain(spark, spread):
    rng = np.random.default_rng(3)
    rows = [(i, (rng.normal(size=20) * math.exp(spread * rng.normal())).tolist(), 0) for i in range(400)]
    rows += [(1000 + i, rows[5][1], 0) for i in range(40)] + [(2000, [0.0] * 20, 0)]  # ties, and no direction
    assert result(spark, rows, 10, 7, bucket_rows=32, block_rows=8) == plain(rows, 10, 7)


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0], 1), (1, None, 1), (2, [], 1), (3, [1.0, None], 1), (4, [nan, 1.0], 1), (5, [inf, 1.0], 1),
            (6, [0.5, -0.5], None), (7, [1.0, 2.0, 3.0], 1), (8, [-1.0, -2.0], 1), (None, [9.0, 9.0], 1), (10, [1.0, 2.0], 1)]
    assert result(spark, rows, 3) == plain(rows, 3)
    assert result(spark, [], 3) == set()
    assert result(spark, rows[:1], 3) == set()


def test_repeated_rows(spark):
    rows = [(0, [1.0, 1.0], 0), (0, [1.0, 1.0], 0), (1, [2.0, 1.0], 0), (1, [2.0, 1.0], 0), (2, [1.0, 0.0], 0)]
    got = result(spark, rows, 2)
    assert {r for r in got if r[0] == 0} == {(0, 1, 1, 3 * 1024 * 1024), (0, 2, 1, 3 * 1024 * 1024)}


def test_pruning_loses_nothing():
    rng = np.random.default_rng(5)
    bucket = (rng.normal(size=(500, 24)) * 300).astype(np.int64)
    lengths = np.sqrt((bucket.astype(float) ** 2).sum(axis=1))
    order = np.argsort(-lengths, kind="stable")
    bucket, lengths = bucket[order], lengths[order]
    fewer = 0
    for _ in range(50):
        q = (rng.normal(size=24) * 300).astype(np.int64)
        scores = bucket @ q
        for bound in (np.sort(scores)[-5], np.sort(scores)[-100], 0, -5, scores.max() + 1):
            kept = topk.survivors(q, bucket, lengths, float(bound))
            assert set(np.flatnonzero(scores >= bound)) <= set(kept.tolist())
            fewer += len(kept) < 250
    assert fewer > 20


def test_large_products_are_exact_or_refused():
    a = np.array([[1 << 29, 1]], np.int64)
    assert topk._products(a, a)[0, 0] == (1 << 58) + 1
    with pytest.raises(OverflowError):
        topk._products(a * (1 << 3), a * (1 << 3))


def test_best_breaks_ties_by_id():
    rng = random.Random(1)
    ids = np.array(rng.sample(range(1000), 300))
    scores = np.array([rng.randrange(4) for _ in ids])
    want = sorted(zip((-scores).tolist(), ids.tolist()))[:10]
    assert [(-scores[i], ids[i]) for i in topk._best(ids, scores, 10)] == want
