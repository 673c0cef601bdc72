import random
import re

import numpy as np
import pyarrow as pa
import pytest
from helpers import EDGES, table

from marquee.llm import graph, jaccard


def shingles(t):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    return frozenset(tuple(w[i:i + 5]) for i in range(max(len(w) - 4, 1))) if w else frozenset()


def plain(rows, percent=75):
    """(doc_id, text) -> (set size, component) by comparing all pairs."""
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i, x in enumerate(sets):
        for j in range(i):
            if x and sets[j] and 100 * len(x & sets[j]) >= percent * len(x | sets[j]):
                root[find(i)] = find(j)
    first = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            first[find(i)] = min(first.get(find(i), doc), doc)
    return sorted((str(doc), len(sets[i]), str(first.get(find(i), doc) if sets[i] else doc)) for i, (doc, _) in enumerate(rows))


def near_copies(seed, groups=12, size=8, extra=""):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    rows = []
    for _ in range(groups):
        base = [rng.choice(words) for _ in range(rng.randrange(5, 80))]
        for _ in range(rng.randrange(1, size)):
            own = list(base)
            for _ in range(rng.randrange(0, 1 + len(base) // 15)):
                own[rng.randrange(len(own))] = rng.choice(words)
            if rng.random() < .3:
                own = own[rng.randrange(0, 4):]
            rows.append((len(rows), extra + rng.choice([" ", "  \n"]).join(own)))
    rng.shuffle(rows)
    return rows


def result(df):
    return sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"])) for r in df.collect())


@pytest.mark.parametrize("seed,large,share", [(1, 64, 0.005), (2, 2, 0.2)])
def test_against_all_pairs(spark, monkeypatch, seed, large, share):
    monkeypatch.setattr(jaccard, "LARGE_GROUP", large)
    rows = near_copies(seed)
    # a passage that many otherwise different documents share, next to the threshold
    rng = random.Random(seed)
    passage = " ".join(f"p{i}" for i in range(40))
    rows += [(1000 + i, passage + " " + " ".join(f"q{rng.randrange(300)}" for _ in range(rng.randrange(3, 16)))) for i in range(60)]
    assert result(jaccard.near_duplicates(table(spark, rows))) == plain(rows)


def test_without_stars(spark, monkeypatch):
    """All links found by groups and combinations alone."""
    monkeypatch.setattr(jaccard, "LARGE_GROUP", 1)
    monkeypatch.setattr(jaccard, "STAR_ROUNDS", 0)
    rows = near_copies(7)
    assert result(jaccard.near_duplicates(table(spark, rows))) == plain(rows)


def test_edges(spark):
    rows = [*EDGES, (12, "One\tTWO  three"), (13, "one two three"), (14, "one two"), (15, "É a b c d e"), (16, "é a b c d e")]
    df = table(spark, rows, extra=("n", "sid", "root", "first", "component_id"))
    assert result(jaccard.near_duplicates(df)) == plain(rows)


def test_empty(spark):
    assert jaccard.near_duplicates(table(spark, [])).collect() == []


def test_shingler_is_the_same_in_any_slice():
    texts = [t for _, t in near_copies(3)] + [None, "", " x ", "A b"]
    one, to = jaccard.Shingler()(pa.array(texts, pa.string()))
    for i, t in enumerate(texts):
        alone, _ = jaccard.Shingler()(pa.array([t], pa.string()))
        assert (one[to[i]:to[i + 1]] == alone).all()
        assert len(np.unique(alone)) == len(shingles(t))


def test_components(spark):
    rng = random.Random(4)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(1000, 1100)] + \
        [(5000, 5000 + i) for i in range(200)] + [(9, 9)]
    got = dict(map(tuple, graph.connected_components(spark.createDataFrame(links, "a long, b long")).collect()))
    root = {x: x for link in links for x in link}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    assert got == {x: find(x) for x in root}
    assert graph.connected_components(spark.createDataFrame([], "a long, b long")).collect() == []
