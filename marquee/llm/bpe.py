"""Byte-level BPE encoding and decoding with the tiktoken library.

The ranks come from a local file; long texts are cut at safe boundaries
before the pattern is applied (see :func:`text_arrow.safe_cuts`), and ids are
decoded back to raw bytes, so bytes that are no text on their own survive.
"""

from __future__ import annotations

import base64
import functools
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.text_arrow import PieceEncoder, slices

RANKS = "byte_bpe_50k.tiktoken"
SLICE_BYTES = 512 << 10
#: Different pieces that a worker remembers: they are indexed anew for each slice.
KEEP = 50_000


def default_ranks() -> str:
    import public_tokenizers
    return public_tokenizers.path(RANKS)


def default_pattern() -> str:
    import public_tokenizers
    return public_tokenizers.PATTERN


@functools.lru_cache(maxsize=4)
def encoding(ranks_path: str, pattern: str):
    """The tiktoken encoding of a rank file, once per worker process."""
    import tiktoken
    with open(ranks_path, "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
    return tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


@functools.lru_cache(maxsize=4)
def piece_encoder(ranks_path: str, pattern: str) -> PieceEncoder:
    one = encoding(ranks_path, pattern).encode_ordinary
    return PieceEncoder(lambda texts: [one(t) for t in texts], KEEP)


def encode_documents(docs: DataFrame, ranks_path: str | None = None, pattern: str | None = None,
                     id_col: str = "doc_id", text_col: str = "text",
                     with_ids: bool = False) -> DataFrame:
    """Encode each whole text and decode the ids again; one row per input row.

    Returns ``doc_id``, ``n_tokens``, ``ids_sha256`` (ids as little-endian
    unsigned 32-bit integers), ``decoded_sha256`` (the decoded bytes) and
    ``round_trip`` (whether those bytes are the text's).  ``with_ids`` adds
    ``ids``, an array of the ids.  Other columns of ``docs`` are not read.

    Null and empty texts have no ids; a null id column stays null; repeated
    rows give repeated rows; an empty table gives an empty result.  Special
    token strings in a text are ordinary text.  A task holds about
    ``SLICE_BYTES`` of text at a time, or one text if that is longer.
    """
    ranks_path, pattern = ranks_path or default_ranks(), pattern or default_pattern()
    out = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, round_trip boolean"
    out += ", ids array<long>" if with_ids else ""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, bpe = piece_encoder(ranks_path, pattern), encoding(ranks_path, pattern)
        for batch in slices(batches, "text", SLICE_BYTES):
            ids, ends = encode(batch.column("text"))
            texts = batch.column("text")
            rows = {"doc_id": batch.column("doc_id"), "n_tokens": [], "ids_sha256": [],
                    "decoded_sha256": [], "round_trip": []}
            parts = []
            for i in range(batch.num_rows):
                own = ids[ends[i]:ends[i + 1]]
                decoded = bpe.decode_bytes(own)
                rows["n_tokens"].append(len(own))
                rows["ids_sha256"].append(hashlib.sha256(own.astype("<u4").tobytes()).hexdigest())
                rows["decoded_sha256"].append(hashlib.sha256(decoded).hexdigest())
                rows["round_trip"].append(decoded == (texts[i].as_py() or "").encode("utf-8"))
                if with_ids:
                    parts.append(own.astype("int64"))
            if with_ids:
                rows["ids"] = pa.array(parts, pa.list_(pa.int64()))
            yield pa.RecordBatch.from_pydict(rows)

    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return own.mapInArrow(run, out)
