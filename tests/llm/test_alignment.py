import hashlib
import random
from collections import Counter

import pyarrow as pa
from helpers import EDGES, table

from marquee.llm import alignment
from marquee.llm.queries import op11_token_alignment
from marquee.llm.token_files import byte_letters

SF = "/root/testdata/sf0.001"
WILD = [" ", "  ", "\n", "\t", "\r\n", " ", " ", "　", "\x1c", "word", "Ab", "é", "日本", "👍🏽", "'s", "123", "!!", "<|endoftext|>", "\x00",
        "ß", "﻿", "▁", "<0x41>", "<s>", "ﬁ", "é", "𝒳", "́", " x", "the ", " "]


class Plain:
    """Both libraries on whole texts, and all pairs of tokens."""

    def __init__(self):
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer
        a, b = alignment.default_paths()
        self.a, self.b = Tokenizer.from_file(a), SentencePieceProcessor(model_file=b)
        self.a.encode_special_tokens = True
        letters = {c: i for i, c in enumerate(byte_letters())}
        self.a_bytes = {i: bytes(letters[c] for c in t) if all(c in letters for c in t) else t.encode() for t, i in self.a.get_vocab().items()}

    def b_bytes(self, i):
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()

    def __call__(self, text):
        if not text:
            return 0, 0, 0, 0, "", Counter()
        a, b = self.a.encode(" " + text, add_special_tokens=False).ids, self.b.encode(text)
        whole = (" " + text).encode()
        a_bytes, b_bytes = [self.a_bytes[i] for i in a], [self.b_bytes(i) for i in b]
        if b"".join(a_bytes) != whole or b"".join(b_bytes) != whole:
            return 0, 0, 0, 0, "", Counter()

        def spans(tokens):
            at = 0
            for t in tokens:
                yield at, at + len(t)
                at += len(t)
        sa, sb = list(spans(a_bytes)), list(spans(b_bytes))
        links, j = Counter(), 0
        for i, (x, y) in enumerate(sa):
            while sb[j][1] <= x:
                j += 1
            k = j
            while k < len(sb) and sb[k][0] < y:
                links[a[i] << 32 | b[k]] += 1
                k += 1
        both = sorted({y for _, y in sa} & {y for _, y in sb})
        groups, low, i, j = [], 0, 0, 0
        for end in both:
            ga, gb = [], []
            while i < len(sa) and sa[i][1] <= end:
                ga.append(str(a[i]))
                i += 1
            while j < len(sb) and sb[j][1] <= end:
                gb.append(str(b[j]))
                j += 1
            groups.append(",".join(ga) + "|" + ",".join(gb))
        return len(a), len(b), len(both), sum(links.values()), ";".join(groups), links


def wild_texts(n):
    rng = random.Random(5)
    return ["a ", " a", "a  ", "\n", "▁", "a▁b", " ", *["".join(rng.choice(WILD) for _ in range(rng.randrange(25))) for _ in range(n)]]


def test_against_plain(spark):
    plain = Plain()
    rows = [*EDGES, *[(100 + i, t) for i, t in enumerate(wild_texts(600))]]
    got = alignment.align_texts(table(spark, rows, extra=("groups", "links", "row"))).collect()
    mine = sorted((r.doc_id is None, r.doc_id or 0, r.n_a, r.n_b, r.n_groups, r.n_links, r.groups, sorted((x.pair, x.times) for x in r.links)) for r in got)
    want = []
    for i, t in rows:
        *counts, links = plain(t)
        want.append((i is None, i or 0, *counts, sorted(links.items())))
    assert mine == sorted(want)
    assert len({r.row for r in got}) == len(rows)


def test_pieces_that_are_forgotten(spark):
    """Texts give the same rows whatever is remembered, and one by one."""
    encoder, small = alignment.PairEncoder(*alignment.default_paths()), alignment.PairEncoder(*alignment.default_paths(), keep=3)
    texts = [" " + t for t in wild_texts(200) if t]
    one = [alignment._aligned(small, pa.array([t], pa.large_string())) for t in texts]
    many = alignment._aligned(encoder, pa.array(texts, pa.large_string()))
    for k in range(6):
        assert many[k].to_pylist() == [c[k][0].as_py() for c in one]
    assert len(small.known) <= 3


def test_counts_over_all_documents(spark):
    rows = [(1, "the cat"), (2, "the cat sat"), (2, "the cat sat"), (3, "a dog"), (4, None), (None, "the dog"), (5, "a▁b")]
    aligned = alignment.align_texts(table(spark, rows)).cache()
    plain = Plain()
    held = Counter(p for _, t in rows for p in plain(t)[5])
    highest = Counter()
    for p, n in held.items():
        highest[p >> 32] = max(highest[p >> 32], n)
    want = sorted((-1 if i is None else i, sum(n for p, n in plain(t)[5].items() if held[p] == highest[p >> 32]), sum(n * held[p] for p, n in plain(t)[5].items()))
                  for i, t in rows)
    for max_bytes, share in ((1 << 26, 0.001), (0, 0.3), (0, 0.0), (0, 1.0)):
        got = alignment.score_links(aligned, max_bytes, share).collect()
        assert sorted((-1 if r.doc_id is None else r.doc_id, r.n_best, r.count_sum) for r in got) == want


def test_empty(spark):
    aligned = alignment.align_texts(table(spark, []))
    assert aligned.collect() == [] and alignment.score_links(aligned).collect() == []


def test_query_against_plain(spark):
    plain = Plain()
    docs = {r.doc_id: plain(r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    held, highest = Counter(p for d in docs.values() for p in d[5]), Counter()
    for p, n in held.items():
        highest[p >> 32] = max(highest[p >> 32], n)
    got = op11_token_alignment(spark, SF).collect()
    assert len(got) == len(docs)
    for r in got:
        a, b, groups, n, text, links = docs[r.doc_id]
        assert (r.n_a, r.n_b, r.n_groups, r.n_links) == (a, b, groups, n)
        assert r.n_best == sum(k for p, k in links.items() if held[p] == highest[p >> 32])
        assert r.count_sum == sum(k * held[p] for p, k in links.items())
        assert r.groups_sha256 == (hashlib.sha256(text.encode()).hexdigest() if a else "")
