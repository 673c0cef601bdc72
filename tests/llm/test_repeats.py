import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from helpers import EDGES, table

from marquee.llm import repeats


def plain(rows, length=200, keep="none"):
    """Rows of (doc_id, n_bytes, n_removed, n_spans, sha) by looking at every string."""
    texts = [(t or "").encode() for _, t in rows]
    where = {}
    for i, t in enumerate(texts):
        for k in range(len(t) - length + 1):
            where.setdefault(t[k:k + length], []).append((i, k))
    gone = [np.zeros(len(t), bool) for t in texts]
    for places in where.values():
        if len(places) > 1:
            for i, k in places[1:] if keep == "first" else places:
                gone[i][k:k + length] = True
    out = []
    for (doc, _), t, g in zip(rows, texts, gone):
        left = bytes(np.frombuffer(t, np.uint8)[~g])
        spans = int((np.diff(np.concatenate(([0], g.astype(int)))) == 1).sum())
        out.append((str(doc), len(t), int(g.sum()), spans, hashlib.sha256(left).hexdigest()))
    return sorted(out)


def result(df):
    return sorted((str(r[0]), *tuple(r)[1:5]) for r in df.collect())


def passages(seed, length, n=40, alphabet="abcdé "):
    rng = random.Random(seed)
    text = lambda k: "".join(rng.choice(alphabet) for _ in range(k))
    shared = [text(rng.randrange(length - 20, 4 * length)) for _ in range(6)]
    rows = []
    for i in range(n):
        own = ""
        for _ in range(rng.randrange(4)):
            own += text(rng.randrange(2 * length)) if rng.random() < .5 else rng.choice(shared)
        rows.append((i, own))
    return rows + [(n, shared[0]), (n + 1, rows[3][1]), (n + 2, "z" * (3 * length)), (n + 3, "yx" * length)]


@pytest.mark.parametrize("seed,group", [(1, 256), (2, 256), (3, 1)])
def test_against_plain(spark, monkeypatch, seed, group):
    monkeypatch.setattr(repeats.find_repeats, "__defaults__", (200, "none", 64, group))
    rows = passages(seed, 200)
    assert result(repeats.remove_repeats(table(spark, rows))) == plain(rows)


@pytest.mark.parametrize("group", [256, 1])
def test_keep_first(spark, monkeypatch, group):
    # "content" orders rows of one id only, so ids decide here
    monkeypatch.setattr(repeats.find_repeats, "__defaults__", (200, "none", 64, group))
    rows = passages(5, 200)
    assert result(repeats.remove_repeats(table(spark, rows), keep="first")) == plain(rows, keep="first")


def test_edges(spark):
    twice = [(30, "q" + "same passage of some length " * 9), (30, "q" + "same passage of some length " * 9), (31, "x" * 199), (32, "x" * 199)]
    rows = [*EDGES, *twice, (None, "n" * 250), (None, "m" + "n" * 250)]
    df = table(spark, rows, extra=("content", "lo", "spans", "n"))
    assert result(repeats.remove_repeats(df)) == plain(rows)
    kept = repeats.remove_repeats(df, with_bytes=True).collect()
    assert all(hashlib.sha256(bytes(r["kept"])).hexdigest() == r["kept_sha256"] for r in kept)


def test_empty(spark):
    assert repeats.remove_repeats(table(spark, [])).collect() == []


def test_factors_against_plain():
    rng = random.Random(8)
    for n in (40, 300):
        data = np.frombuffer(bytes(rng.choice(b"ab") for _ in range(n)) + bytes(8), np.uint8)
        starts = np.arange(n - 16 + 1)
        raw = data.tobytes()
        lpf, source = repeats.previous_factors(repeats.suffix_ranks(data, 16), starts, starts, 16)
        for i in starts:
            best = 0
            for j in range(i):
                k = 0
                while k < 16 and raw[i + k] == raw[j + k]:
                    k += 1
                best = max(best, k if k == 16 else k // 8 * 8)
            assert lpf[i] == best
            if best:
                assert source[i] < i and raw[i:i + best] == raw[source[i]:source[i] + best]


def test_anchors_cover_every_start_once():
    rows = passages(9, 200)
    texts = pa.array([t for _, t in rows] + ["", "short"])
    data, offsets = repeats.text_bytes(texts)
    lo, hi, _, _ = repeats.anchors(repeats.Hashes(), data, offsets, 200, 64)
    got = [s for a, b in zip(lo.tolist(), hi.tolist()) for s in range(a, b + 1)]
    want = [s for a, b in zip(offsets[:-1], offsets[1:]) for s in range(a, b - 200 + 1)]
    assert got == want
