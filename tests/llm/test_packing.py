import zlib
from collections import defaultdict

import numpy as np
import pytest
from helpers import EDGES, table

from marquee.llm import packing
from marquee.llm.queries import op13_curve_packing

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("dims,bits", [(2, 4), (3, 3), (4, 2)])
def test_curve_visits_neighbours(dims, bits):
    grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), -1).reshape(-1, dims)
    keys = packing.hilbert_keys(grid, bits)
    assert sorted(keys.tolist()) == list(range(len(grid)))
    assert (np.abs(np.diff(grid[np.argsort(keys)], axis=0)).sum(axis=1) == 1).all()


def test_bounds():
    for total in (0, 1, 4095, 4096, 4097, 3 * 4096 + 2047):
        bounds = packing.sequence_bounds(total, 4096)
        sizes = np.diff(bounds).tolist()
        assert bounds[0] == total // 4096 * 4096 and bounds[-1] == total
        assert all(s & (s - 1) == 0 for s in sizes) and sizes == sorted(set(sizes), reverse=True)


def plain_ids(text):
    from tokenizers import Tokenizer
    if not hasattr(plain_ids, "tokenizer"):
        plain_ids.tokenizer = Tokenizer.from_file(packing.default_tokenizer())
    return np.array(plain_ids.tokenizer.encode(text or "", add_special_tokens=False).ids + [2], "<u4")


def check_packed(pieces, texts, length):
    """Pieces give whole documents and gapless sequences; sizes but powers of
    two are full."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append(p)
        by_sequence[p.sequence_id].append(p)
    for doc_id, own in texts.items():
        want = sorted(plain_ids(t).tobytes() for t in own)
        found = sorted(by_doc[doc_id], key=lambda p: (p.sequence_id, p.offset))
        whole, rows = [], []
        for p in found:
            assert len(p.ids) == 4 * p.length and p.length > 0
            if p.start == 0:
                whole.append(b"")
            assert p.start == len(whole[-1]) // 4
            whole[-1] += p.ids
            rows.append(p.doc_tokens)
        assert sorted(whole) == want
    assert set(by_doc) == set(texts)
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    for s, own in by_sequence.items():
        end = 0
        for p in sorted(own, key=lambda p: p.offset):
            assert p.offset == end
            end += p.length
        assert end == length or (end < length and end & (end - 1) == 0)


def test_against_plain(spark):
    rows = [*EDGES, *[(100 + i, f"topic{i % 3} word{i} <|endoftext|> " * (i % 7)) for i in range(60)]]
    texts = defaultdict(list)
    for i, t in rows:
        texts[i].append(t)
    for length in (4096, 16):
        pieces = packing.pack_documents(table(spark, rows, extra=("key", "row", "ids", "n")), length=length).collect()
        check_packed(pieces, texts, length)


def test_sequences(spark):
    rows = [(i, f"word{i} " * (i + 1)) for i in range(30)]
    pieces = packing.pack_documents(table(spark, rows), length=64)
    total = sum(len(plain_ids(t)) for _, t in rows)
    found = packing.sequences(pieces, 64).collect()
    assert sum(r.n_tokens for r in found) == total
    assert all(len(r.ids) == (r.n_tokens if r.n_tokens & (r.n_tokens - 1) == 0 else 64) and r.starts[0] == 0 for r in found)


def test_neighbours_share_words(spark):
    """Documents of one topic are neighbours far more often than by chance."""
    words = [[f"{a}{b}" for b in "abcdefghij"] for a in ("cat", "dog", "tree", "moon", "fish", "lamp")]
    rng = np.random.default_rng(1)
    rows = [(i, " ".join(rng.choice(words[i % 6], 60))) for i in range(600)]
    pieces = sorted(packing.pack_documents(table(spark, rows)).filter("start = 0").collect(), key=lambda p: (p.sequence_id, p.offset))
    same = sum(a.doc_id % 6 == b.doc_id % 6 for a, b in zip(pieces, pieces[1:]))
    assert same > 0.8 * len(pieces)


def test_copies_and_empty(spark):
    assert packing.pack_documents(table(spark, [])).collect() == []
    rows = [(7, "one text for all")] * 500 + [(None, "one text for all")] * 10
    pieces = packing.pack_documents(table(spark, rows), length=32).collect()
    check_packed(pieces, {7: ["one text for all"] * 500, None: ["one text for all"] * 10}, 32)
    with pytest.raises(ValueError):
        packing.pack_documents(table(spark, []), length=100)


def test_query(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = op13_curve_packing(spark, SF).collect()
    for r in got:
        ids = plain_ids(docs[r.doc_id])
        assert r.doc_tokens == len(ids) and r.ids_crc32 == zlib.crc32(ids[r.start:r.start + r.length].tobytes())
    assert sum(r.length for r in got) == sum(len(plain_ids(t)) for t in docs.values())
    assert {r.doc_id for r in got} == set(docs)
