import hashlib
import random
import re
import zlib
from fractions import Fraction

import pytest
from helpers import EDGES, table

from marquee.llm import periods
from marquee.llm.queries import op12_periodic_runs, repetitive_documents

SF = "/root/testdata/sf0.001"


def plain_runs(words, exponent=4, least=6):
    """Every maximal stretch of every period, of which no smaller one holds."""
    out = []
    for q in range(1, len(words) // exponent + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            n = j + q - i
            if j > i and n >= max(least, exponent * q) and not any(
                    all(words[x] == words[x + r] for x in range(i, i + n - r)) for r in range(1, q)):
                out.append((i, n, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def words_of(text):
    return re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())


def collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return b" ".join(w for i, w in enumerate(words) if i not in gone)


def random_text(rng):
    words = [rng.choice(["a", "b", "A", "é", " "]) for _ in range(rng.randrange(40))]
    if rng.random() < 0.6:
        block = [rng.choice("abc") for _ in range(rng.randrange(1, 8))]
        at = rng.randrange(len(words) + 1)
        words[at:at] = (block * 20)[:rng.randrange(60)]
    return rng.choice([" ", "\n", " \t"]).join(words)


def test_against_plain(spark):
    rng = random.Random(5)
    rows = [*EDGES, *[(100 + i, random_text(rng)) for i in range(400)], (99, "x " * 5000), (98, "p q r s t " * 2000 + "z")]
    got = periods.periodic_runs(table(spark, rows, extra=("runs", "start", "n_words"))).collect()
    key = lambda i, t: (i is None, i or 0, t or "")
    assert len(got) == len(rows)
    want = []
    for i, t in rows:
        words = words_of(t)
        if i in (98, 99):
            runs = [(0, 5000, 1)] if i == 99 else [(0, 10000, 5)]
        else:
            runs = plain_runs(words) if len(words) < 500 else []
        want.append((i, len(words), runs, collapsed(words, runs).decode()))
    want.sort(key=lambda r: key(r[0], r[3]))
    got = sorted(((r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in got), key=lambda r: key(r[0], r[3]))
    assert got == want


def test_empty_and_parameters(spark):
    assert periods.periodic_runs(table(spark, [])).collect() == []
    with pytest.raises(ValueError):
        periods.periodic_runs(table(spark, []), min_exponent=3)
    rows = [(1, "a b " * 5 + "c c c c c c")]
    assert [tuple(x) for x in periods.periodic_runs(table(spark, rows), min_exponent=6).first().runs] == [(10, 6, 1)]


def test_query_against_plain(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = {r.doc_id: r for r in op12_periodic_runs(spark, SF).collect()}
    assert got.keys() == docs.keys()
    made = 0
    for i, text in docs.items():
        words, h = words_of(text), zlib.crc32(str(i).encode())
        n, g = len(words), h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[x if x < a else a + (x - a) % p] for x in range(n)]
            made += 1
        runs = plain_runs(words) if n < 3000 else None
        if runs is None:
            continue
        r = got[i]
        best = max(runs, key=lambda x: (Fraction(x[1], x[2]), -x[0], -x[2])) if runs else None
        assert (r.n_runs, r.runs_sha256) == (len(runs), hashlib.sha256("".join(f"{s},{m},{q}\n" for s, m, q in runs).encode()).hexdigest())
        assert r.collapsed_sha256 == hashlib.sha256(collapsed(words, runs)).hexdigest()
        assert (r.start, r.length, r.period, r.exponent_milli) == ((*best, 1000 * best[1] // best[2]) if best else (None,) * 4)
    assert made > 10


def test_query_documents_without_id_or_text(spark):
    rows = [(None, "a b c"), (0, None), (0, ""), (0, "  "), *[(i, "a b c d e f g") for i in range(40)]]
    got = repetitive_documents(table(spark, rows, extra=("words", "a", "p"))).collect()
    assert len(got) == len(rows) and sorted(r.text or "" for r in got)[:3] == ["", "", "  "]
