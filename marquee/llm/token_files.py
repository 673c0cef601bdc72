"""Token-id files: fixed-size blocks of ids as compressed byte or bit planes.

A file is

    MAGIC | block, block, ... | index (zstandard, JSON head and arrays) | length of the index (u64) | MAGIC

A block holds ``block_ids`` ids (the last one fewer).  Its ids are transposed
into planes: plane k has byte k (or bit k) of every id, and each plane is
compressed by itself, so the high planes, all zero, cost nothing.  The chunk
index in the tail has each block's place, its number of ids and the sizes of
its planes, and the documents' ids and lengths in order; a reader seeks to the
blocks it needs.

Files are written by the tasks through ``pyarrow.fs`` into a shared folder.
Each attempt of a task writes files of its own name, and only the files named
by the manifest that Spark keeps are read; a lost executor costs its attempt's
files and nothing else.
"""

from __future__ import annotations

import functools
import json
import os
import re
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marquee.llm.text_arrow import PieceEncoder, slices
from marquee.session import materialize, staging_dir

TOKENIZER = "byte_bpe_50k.json"
MAGIC = b"MQTOKEN1"
BLOCK_IDS = 1 << 16
FILE_IDS = 1 << 25  # a new file begins at the document after so many ids
SLICE_BYTES = 4 << 20
END_ID = 2


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path(TOKENIZER)


#: Steps before the model (normalizer, pre-tokenizer) after which a space, Latin-1
#: letters and a full stop or comma are one word and one of that mark, in byte
#: letters; what stands for the space, and whether letters become small.
_BYTES = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True}
_ONE_WORD = [
    ((None, _BYTES | {"use_regex": True}), ("\u0120", False)),
    (({"type": "Sequence", "normalizers": [
        {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]},
      {"type": "Sequence", "pretokenizers": [
          {"type": "Split", "behavior": "Removed", "invert": True, "pattern": {
              "Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}},
          _BYTES | {"use_regex": False}]}), ("", True)),
]
_LETTERS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff"


@functools.lru_cache(maxsize=4)
def piece_encoder(path: str) -> PieceEncoder:
    """The library's plain call without added special tokens.  A special
    token's string has no white space, so no cut is within it.

    Most pieces are a space and a word of Latin-1 letters, maybe with a full
    stop or comma.  Where the steps before the model are known to make one
    word of it and no added token is in it, the model gets the word at once.
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(path)
    spec = json.loads(tokenizer.to_str())
    known = next((how for steps, how in _ONE_WORD if steps == (spec["normalizer"], spec["pre_tokenizer"])), None)
    if any(re.fullmatch(f"[{_LETTERS} .,]*", t["content"]) or t["normalized"] for t in spec["added_tokens"]):
        known = None

    def plain(texts: list[str]) -> list[list[int]]:
        return [e.ids for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
    if known is None:
        return PieceEncoder(plain)
    (space, small), tokenize = known, tokenizer.model.tokenize
    match, letters = re.compile(f" ([{_LETTERS}]+)([.,]?)").fullmatch, byte_letters()
    as_bytes = {c: "".join(letters[b] for b in chr(c).encode()) for c in range(128, 256)}
    marks = {"": [], **{m: [x.id for x in tokenize(m)] for m in ".,"}}

    def encode(texts: list[str]) -> list[list[int]]:
        out, other = [], []
        for i, t in enumerate(texts):
            if m := match(t):
                word, mark = m.groups()
                if small:
                    word = word.lower()
                if not word.isascii():
                    word = word.translate(as_bytes)
                out.append([x.id for x in tokenize(space + word)] + marks[mark])
            else:
                out.append(None)
                other.append(i)
        for i, ids in zip(other, plain([texts[i] for i in other])):
            out[i] = ids
        return out
    return PieceEncoder(encode)


def byte_letters() -> list[str]:
    """The letters that stand for bytes in byte-level vocabularies: printable
    Latin-1 characters for themselves, the others from U+0100 on, in order."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(spare)) for b in range(256)]


# -- planes ------------------------------------------------------------------

def to_planes(ids: np.ndarray, kind: str = "byte") -> list[bytes]:
    """The planes of a block of unsigned 32-bit ids, lowest first."""
    own = np.ascontiguousarray(ids, dtype="<u4").view(np.uint8).reshape(-1, 4)
    if kind == "byte":
        return [own[:, k].tobytes() for k in range(4)]
    bits = np.unpackbits(own, axis=1, bitorder="little")
    return [np.packbits(bits[:, k], bitorder="little").tobytes() for k in range(32)]


def from_planes(planes: list[bytes], n: int, kind: str = "byte") -> np.ndarray:
    if kind == "byte":
        out = np.empty((n, 4), np.uint8)
        for k, plane in enumerate(planes):
            out[:, k] = np.frombuffer(plane, np.uint8)
    else:
        bits = np.empty((n, 32), np.uint8)
        for k, plane in enumerate(planes):
            bits[:, k] = np.unpackbits(np.frombuffer(plane, np.uint8), bitorder="little", count=n)
        out = np.packbits(bits, axis=1, bitorder="little")
    return np.ascontiguousarray(out).view("<u4").reshape(-1)


class FileWriter:
    """Writes one token file; ids are held for one block at most."""

    def __init__(self, sink, kind: str = "byte", block_ids: int = BLOCK_IDS, level: int = 1):
        self.sink, self.kind, self.block_ids = sink, kind, block_ids
        self.zstd = zstandard.ZstdCompressor(level=level)
        self.waiting: list[np.ndarray] = []
        self.n_waiting, self.n_ids, self.at = 0, 0, len(MAGIC)
        self.blocks: list[list] = []
        self.doc_ids: list[int | None] = []
        self.lengths: list[int] = []
        sink.write(MAGIC)

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.doc_ids.append(doc_id)
        self.lengths.append(len(ids))
        self.waiting.append(ids)
        self.n_waiting += len(ids)
        self.n_ids += len(ids)
        if self.n_waiting >= self.block_ids:
            own = np.concatenate(self.waiting)
            full = len(own) // self.block_ids * self.block_ids
            for i in range(0, full, self.block_ids):
                self._block(own[i:i + self.block_ids])
            self.waiting, self.n_waiting = [own[full:]], len(own) - full

    def _block(self, ids: np.ndarray) -> None:
        planes = [self.zstd.compress(p) for p in to_planes(ids, self.kind)]
        self.blocks.append([self.at, len(ids), *map(len, planes)])
        for p in planes:
            self.sink.write(p)
            self.at += len(p)

    def close(self) -> None:
        if self.n_waiting:
            self._block(np.concatenate(self.waiting))
        index = self.zstd.compress(json.dumps({
            "kind": self.kind, "blocks": self.blocks, "doc_ids": self.doc_ids, "lengths": self.lengths}).encode())
        self.sink.write(index + struct.pack("<Q", len(index)) + MAGIC)


class FileReader:
    """Reads a token file block by block through its chunk index."""

    def __init__(self, source):
        size = source.size()
        source.seek(size - 8 - len(MAGIC))
        length, magic = struct.unpack("<Q8s", source.read(8 + len(MAGIC)))
        if magic != MAGIC:
            raise ValueError("not a token file, or not written to its end")
        self.zstd = zstandard.ZstdDecompressor()
        source.seek(size - 8 - len(MAGIC) - length)
        index = json.loads(self.zstd.decompress(source.read(length)))
        self.source, self.kind, self.blocks = source, index["kind"], index["blocks"]
        self.doc_ids, self.lengths = index["doc_ids"], index["lengths"]

    def block(self, k: int) -> np.ndarray:
        at, n, *sizes = self.blocks[k]
        self.source.seek(at)
        return from_planes([self.zstd.decompress(self.source.read(s)) for s in sizes], n, self.kind)

    def documents(self) -> Iterator[tuple[int | None, np.ndarray]]:
        """(doc_id, ids) in the file's order; holds a document and a block."""
        k, own = 0, np.zeros(0, np.uint32)
        for doc_id, length in zip(self.doc_ids, self.lengths):
            parts, need = [], length
            while need:
                if not len(own):
                    own, k = self.block(k), k + 1
                parts.append(own[:need])
                own, need = own[len(parts[-1]):], need - len(parts[-1])
            yield doc_id, np.concatenate(parts) if parts else np.zeros(0, np.uint32)


# -- Spark -------------------------------------------------------------------

def _filesystem(uri: str):
    from pyarrow import fs
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[len("file:"):]
    if uri.startswith("/"):
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))


def write_token_files(docs: DataFrame, folder: str, tokenizer_path: str | None = None,
                      kind: str = "byte", block_ids: int = BLOCK_IDS, file_ids: int = FILE_IDS,
                      end_id: int | None = END_ID, id_col: str = "doc_id",
                      text_col: str = "text") -> DataFrame:
    """Encode texts and write their ids to token files in ascending id order.

    Returns the manifest, kept as a table: ``shard`` and ``part`` (their order
    is the files' order), ``name``, ``n_docs``, ``n_ids``.  ``end_id`` is
    appended to each document.  Texts are encoded as the tokenizer's plain call
    without added special tokens does; the string of a special token in a text
    becomes that token.  Rows are dealt by ranges of the id column;
    equal ids are ordered by text; null ids come first.  Null texts are
    empty; an empty table gives an empty manifest.  Other columns are not
    read.
    """
    tokenizer_path = tokenizer_path or default_tokenizer()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, shard = piece_encoder(tokenizer_path), TaskContext.get().partitionId()
        filesystem, root = _filesystem(folder)
        tail = np.array([] if end_id is None else [end_id], np.uint32)
        part, writer, sink, name = 0, None, None, ""
        for batch in slices(batches, "text", SLICE_BYTES):
            ids, ends = encode(batch.column("text"))
            for i, doc_id in enumerate(batch.column("doc_id").to_pylist()):
                if writer is None:
                    name = f"shard-{shard:06d}-{part:04d}-{uuid.uuid4().hex[:12]}.tok"
                    filesystem.create_dir(root, recursive=True)
                    sink = filesystem.open_output_stream(f"{root}/{name}")
                    writer = FileWriter(sink, kind, block_ids)
                writer.add(doc_id, np.concatenate((ids[ends[i]:ends[i + 1]], tail)))
                if writer.n_ids >= file_ids:
                    writer.close()
                    sink.close()
                    yield _manifest_row(shard, part, name, writer)
                    part, writer = part + 1, None
        if writer is not None:
            writer.close()
            sink.close()
            yield _manifest_row(shard, part, name, writer)

    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    ordered = own.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    manifest = ordered.mapInArrow(run, "shard int, part int, name string, n_docs long, n_ids long")
    return materialize(manifest, "token-manifest")


def _manifest_row(shard: int, part: int, name: str, writer: FileWriter) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({
        "shard": pa.array([shard], pa.int32()), "part": pa.array([part], pa.int32()), "name": [name],
        "n_docs": [len(writer.doc_ids)], "n_ids": [writer.n_ids]})


def read_token_files(manifest: DataFrame, folder: str, with_ids: bool = False) -> DataFrame:
    """Documents read back from token files: ``doc_id``, ``start`` (ids of all
    documents before it), ``n_tokens``, ``ids_crc32`` and, if asked, ``ids``.

    Starts come from the manifest alone: totals by shard (as many rows as
    there are shuffle partitions) are summed up in order, then the parts of a
    shard, then the documents of a file in the reading task.
    """
    shards = manifest.groupBy("shard").agg(F.sum("n_ids").alias("own"))
    before = shards.select("shard", (F.sum("own").over(Window.orderBy("shard")) - F.col("own")).alias("shard_start"))
    parts = Window.partitionBy("shard").orderBy("part")
    files = (manifest.join(F.broadcast(before), "shard")
             .select("name", (F.col("shard_start") + F.sum("n_ids").over(parts) - F.col("n_ids")).alias("start")))
    out = "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids array<long>" if with_ids else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filesystem, root = _filesystem(folder)
        for batch in batches:
            for name, start in zip(batch.column("name").to_pylist(), batch.column("start").to_pylist()):
                with filesystem.open_input_file(f"{root}/{name}") as source:
                    rows, held = [], 0
                    for doc_id, ids in FileReader(source).documents():
                        rows.append((doc_id, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes()),
                                     *([ids.astype("int64")] if with_ids else [])))
                        start, held = start + len(ids), held + (len(ids) if with_ids else 1)
                        if held >= 1 << 20:
                            yield _document_rows(rows, with_ids)
                            rows, held = [], 0
                    if rows:
                        yield _document_rows(rows, with_ids)

    spread = max(4 * files.sparkSession.sparkContext.defaultParallelism,
                 int(files.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return files.repartition(spread, "name").mapInArrow(run, out)  # a count, so that tiny rows aren't coalesced


def _document_rows(rows: list[tuple], with_ids: bool) -> pa.RecordBatch:
    names = ["doc_id", "start", "n_tokens", "ids_crc32"] + (["ids"] if with_ids else [])
    kinds = [pa.int64()] * 4 + [pa.list_(pa.int64())]
    return pa.RecordBatch.from_arrays(
        [pa.array(list(column), kind) for column, kind in zip(zip(*rows), kinds)], names=names)


def token_files(spark: SparkSession, docs: DataFrame, folder: str | None = None, **options) -> DataFrame:
    """Write ``docs`` to token files and read every document back."""
    folder = folder or staging_dir(spark, "token-files")
    return read_token_files(write_token_files(docs, folder, **options), folder)
