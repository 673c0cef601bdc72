import hashlib
import io
import random
import zlib

import numpy as np
import pytest
from helpers import EDGES, LONG, table

from marquee.llm import bpe, token_files, text_arrow

WILD = [" ", "  ", "\n", "\t", "\r\n", "\u00a0", "\u2003", "\u3000", "\u0085", "\x1c", "word", "Ab", "é", "日本", "👍",
        "'s", "'ll", "123", "!!", "<|endoftext|>", "\x00", "ß", "\ufeff"]


def wild_texts(n=400):
    rng = random.Random(11)
    return ["".join(rng.choice(WILD) for _ in range(rng.randrange(30))) for _ in range(n)]


def plain_ids(texts):
    import tiktoken  # noqa: F401
    e = bpe.encoding(bpe.default_ranks(), bpe.default_pattern())
    return [e.encode_ordinary(t or "") for t in texts]


def test_bpe_against_library(spark):
    rows = [*EDGES, *[(100 + i, t) for i, t in enumerate(wild_texts())], (99, "a" * 5000), (98, "x" * 300 + " " * 300)]
    got = bpe.encode_documents(table(spark, rows, extra=("n_tokens", "ids")), with_ids=True).collect()
    key = lambda i: (i is not None, i)
    want = sorted(((i, t, ids) for (i, t), ids in zip(rows, plain_ids([t for _, t in rows]))), key=lambda r: key(r[0]))
    got.sort(key=lambda r: key(r["doc_id"]))
    assert len(got) == len(want)
    for r, (i, t, ids) in zip(got, want):
        assert r["doc_id"] == i and r["ids"] == ids and r["n_tokens"] == len(ids) and r["round_trip"]
        assert r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256((t or "").encode()).hexdigest()


def test_bpe_empty(spark):
    assert bpe.encode_documents(table(spark, [])).collect() == []


def test_piece_memory_is_bounded():
    calls = []
    one = bpe.encoding(bpe.default_ranks(), bpe.default_pattern()).encode_ordinary
    e = text_arrow.PieceEncoder(lambda ts: (calls.append(len(ts)), [one(t) for t in ts])[1], keep=5)
    import pyarrow as pa
    texts = wild_texts(200)
    for k in range(0, 200, 10):
        ids, ends = e(pa.array(texts[k:k + 10]))
        for i, t in enumerate(texts[k:k + 10]):
            assert ids[ends[i]:ends[i + 1]].tolist() == one(t)
        assert len(e.known) <= 5


def test_encoding_a_batch_of_texts_is_bounded():
    """Fails where a task encodes 4 MB of text at a time."""
    import tracemalloc

    import pyarrow as pa
    rng = random.Random(5)
    words = ["w%x" % rng.getrandbits(40) for _ in range(70_000)]
    batch = pa.RecordBatch.from_pydict({"text": [" ".join(rng.choices(words, k=200)) for _ in range(1800)]})
    encode = bpe.piece_encoder.__wrapped__(bpe.default_ranks(), bpe.default_pattern())
    tracemalloc.start()
    for own in text_arrow.slices(iter([batch]), "text", bpe.SLICE_BYTES):
        encode(own.column("text"))
    _, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert peak < 40 << 20 and len(encode.known) <= 50_000


@pytest.mark.parametrize("kind", ["byte", "bit"])
def test_planes(kind):
    rng = np.random.default_rng(1)
    for n in (1, 7, 8, 1000):
        ids = rng.integers(0, 1 << 32, n, dtype=np.uint32)
        assert (token_files.from_planes(token_files.to_planes(ids, kind), n, kind) == ids).all()


@pytest.mark.parametrize("kind", ["byte", "bit"])
def test_file_round_trip(kind):
    class Source(io.BytesIO):
        def size(self):
            return len(self.getvalue())
    rng = np.random.default_rng(2)
    docs = [(None if i == 3 else i, rng.integers(0, 50257, n, dtype=np.uint32)) for i, n in enumerate([0, 5, 100, 1, 64, 0, 333, 64])]
    sink = io.BytesIO()
    writer = token_files.FileWriter(sink, kind, block_ids=64)
    for i, ids in docs:
        writer.add(i, ids)
    writer.close()
    reader = token_files.FileReader(Source(sink.getvalue()))
    assert [b[1] for b in reader.blocks] == [64] * 8 + [55]
    assert [(i, x.tolist()) for i, x in reader.documents()] == [(i, x.tolist()) for i, x in docs]
    assert reader.block(3).tolist() == np.concatenate([x for _, x in docs])[192:256].tolist()
    with pytest.raises(ValueError):
        token_files.FileReader(Source(sink.getvalue()[:-3]))


def test_token_files(spark, tmp_path):
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(token_files.default_tokenizer())  # the plain call: nothing is set
    assert len(tokenizer.encode("a <|endoftext|> b", add_special_tokens=False).ids) == 4
    rows = [*EDGES, (90, "a <|endoftext|> b"), (91, "<|endoftext|>x <|endoftext|"), *[(100 + i, t) for i, t in enumerate(wild_texts(150))]]
    got = token_files.token_files(spark, table(spark, rows, extra=("start", "shard")), str(tmp_path / "files"),
                                  block_ids=128, file_ids=1000, kind="bit").collect()
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode()))
    got.sort(key=lambda r: r["start"])
    start = 0
    for r, (i, t) in zip(got, order):
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [2]
        assert (r["doc_id"], r["start"], r["n_tokens"]) == (i, start, len(ids))
        assert r["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)
    assert len(got) == len(rows) and len(list((tmp_path / "files").iterdir())) > 5


def test_token_files_empty(spark):
    assert token_files.token_files(spark, table(spark, [])).collect() == []


def test_cuts_keep_matches():
    import pyarrow as pa
    import regex
    pattern = regex.compile(bpe.default_pattern())
    for t in wild_texts(300) + [LONG[:5000]]:
        data, offsets = text_arrow.text_bytes(pa.array([t]))
        cuts = text_arrow.safe_cuts(data, offsets)
        parts = [data[a:b].tobytes().decode() for a, b in zip(cuts[:-1], cuts[1:])]
        assert [m for p in parts for m in pattern.findall(p)] == pattern.findall(t)


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_words_given_to_the_model(name):
    """Each Latin-1 letter, marks, and what only looks like a plain word."""
    import public_tokenizers
    import pyarrow as pa
    from tokenizers import Tokenizer
    path = public_tokenizers.path(name)
    letters = [chr(c) for c in range(65, 256) if chr(c).isalpha()]
    texts = [f" {c}{d}tion{e}" for c in letters for d in ("", "é", "X") for e in ("", ".", ",", "..", "'s", "́", "1")]
    texts += ["", " ", "a", "É.", " .", ".a", "  ab", "\nAb.", " İx", " xẞ.", " ǅa", " ab<|endoftext|>", " <|startoftext|>ab.", " ªb", " µm", " ×a"]
    whole = Tokenizer.from_file(path)
    encoder = token_files.piece_encoder(path)
    for _ in range(2):  # new pieces, then known ones
        ids, ends = encoder(pa.array(texts))
        for i, t in enumerate(texts):
            assert ids[ends[i]:ends[i + 1]].tolist() == whole.encode(t, add_special_tokens=False).ids, t


def test_known_pieces_take_little_memory():
    """Fails where each known piece is objects of its own (over 200 bytes)."""
    import tracemalloc

    import pyarrow as pa
    one = list(range(3))
    e = text_arrow.PieceEncoder(lambda ts: [one] * len(ts))
    tracemalloc.start()
    for k in range(10):
        e(pa.array([" ".join(f"w{k}x{i}" for i in range(10_000))]))
    held, _ = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert len(e.known) == 100_000 and held < 100_000 * 60
