"""Alignment of two tokenizers' tokens by bytes.

Tokenizer A is a byte-level BPE of the tokenizers library, B a sentencepiece
model with byte fallback.  A's character offsets and the spans of
sentencepiece's proto are coarse: tokens that split a multibyte character, and
fallback tokens for its bytes, share or lack a span.  Where a span ends and the
next begins is a coarse cut; between two coarse cuts, tokens are placed by the
lengths of their decoded bytes.  The decoded bytes of all tokens must be the
text's, else the text has no alignment.

Both tokenizers work word by word, so texts are cut before a space that
follows another character; a cut piece has the same tokens alone as in its
text (:func:`piece_cuts`), each different piece of a batch is encoded once, and
the frequent ones are remembered.

A link is a pair of an A and a B token whose bytes overlap.  Ends of tokens of
either kind cut a text into stretches that lie in one token of each kind, so
links and stretches correspond one to one.
"""

from __future__ import annotations

import functools
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.text_arrow import safe_cuts, slices, text_bytes
from marquee.llm.token_files import byte_letters
from marquee.operators.joins import BROADCAST_MAX_BYTES, measured_bytes
from marquee.session import materialize

TOKENIZER, PIECES = "byte_bpe_50k.json", "piece_bpe_32k.model"
SLICE_BYTES = 2 << 20
#: Pieces that a worker remembers, and pieces that are encoded together.
KEEP, JOINED = 300_000, 512
#: Share of documents from which a link of the pair counts as frequent.
FREQUENT_SHARE = 0.001
#: Stands for a piece whose decoded bytes are not its text.
_BROKEN = 0xFFFFFFFF


def default_paths() -> tuple[str, str]:
    import public_tokenizers
    return public_tokenizers.path(TOKENIZER), public_tokenizers.path(PIECES)


def piece_cuts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """:func:`safe_cuts` before a U+0020 only, and not before one that ends
    its text.

    B's pieces hold a space at their front or throughout (its vocabulary is
    checked when it is loaded), so no merge reaches over such a cut either; B
    adds the space that a text begins with, and has no token for a text without
    more."""
    cuts = safe_cuts(data, offsets)
    edge = np.zeros(len(data) + 2, bool)  # texts' ends, and the places before them
    edge[offsets] = True
    inner = cuts[~edge[cuts]]
    edge[np.maximum(offsets - 1, 0)] = True
    inner = inner[(data[inner] == 32) & ~edge[inner]]
    cut = np.zeros(len(data) + 1, bool)
    cut[offsets] = cut[inner] = True
    return np.flatnonzero(cut)


def _token_ends(begins: np.ndarray, ends: np.ndarray, decoded: np.ndarray) -> np.ndarray:
    """Ends of tokens in bytes.  ``begins`` and ``ends`` are their spans,
    ``decoded`` the lengths of their bytes.  A token that is alone between two
    coarse cuts has its span's length, others that of their bytes."""
    # a coarse cut lies behind a token with a span of its own, whose end the next one's goes beyond
    cut = ends > begins
    cut[:-1] &= (begins[1:] >= ends[:-1]) & (ends[1:] > ends[:-1])
    alone = cut & np.concatenate(([True], cut[:-1]))
    return np.cumsum(np.where(alone, ends - np.concatenate(([0], ends[:-1])), decoded))


def _gathered(flat: np.ndarray, start: np.ndarray, length: np.ndarray, index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``flat[start[i]:start[i] + length[i]]`` for each i of ``index``, end to
    end, and the ends."""
    own = length[index]
    ends = np.cumsum(own)
    where = np.repeat(start[index] - ends + own, own)
    where += np.arange(len(where))
    return flat[where], ends


class PairEncoder:
    """Ids of both tokenizers for texts that begin with a space.

    Remembers the first ``keep`` different pieces of a worker, each as packed
    numbers: how many ids A has for it, A's ids, B's ids.
    """

    def __init__(self, byte_level_path: str, sentence_path: str, keep: int = KEEP):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer
        self.a = Tokenizer.from_file(byte_level_path)
        self.a.encode_special_tokens = True  # their strings in a text are ordinary text
        letters = {letter: b for b, letter in enumerate(byte_letters())}
        self.a_bytes = [b""] * self.a.get_vocab_size()
        for token, i in self.a.get_vocab().items():
            self.a_bytes[i] = bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()
        self.b = SentencePieceProcessor(model_file=sentence_path)
        names = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        if any("▁" in name.lstrip("▁") for name in names):
            raise ValueError(f"{sentence_path}: a piece reaches over the start of a word")
        self.b_bytes = [bytes([int(name[3:5], 16)]) if self.b.is_byte(i) else name.replace("▁", " ").encode()
                        for i, name in enumerate(names)]
        self.a_sizes, self.b_sizes = (np.fromiter(map(len, t), np.int64, len(t)) for t in (self.a_bytes, self.b_bytes))
        self.size = max(len(self.a_bytes), len(self.b_bytes))
        #: Ids as they are shown, followed by a comma, a bar or a semicolon.
        self.shown = pa.array([f"{i}{mark}" for mark in ",|;" for i in range(self.size)], pa.large_string())
        self.keep, self.known = keep, {}

    def _a_tokens(self, text: str, raw: bytes) -> tuple[np.ndarray, np.ndarray]:
        found = self.a.encode(text, add_special_tokens=False)
        ids, spans = np.array(found.ids, np.int64), np.array(found.offsets, np.int64).reshape(-1, 2)
        if len(raw) != len(text):  # offsets of characters to those of bytes
            spans = np.append(np.flatnonzero((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80), len(raw))[spans]
        return ids, _token_ends(spans[:, 0], spans[:, 1], self.a_sizes[ids])

    def _b_tokens(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        found = self.b.encode(text[1:], return_type="proto", num_threads=1)
        rows = np.array([(x.id, x.begin, x.end) for x in found.pieces], np.int64).reshape(-1, 3)
        begins, ends = rows[:, 1] + 1, rows[:, 2] + 1  # spans do not count the added space
        begins[:1] = 0
        return rows[:, 0], _token_ends(begins, ends, self.b_sizes[rows[:, 0]])

    def _packed(self, pieces: list[str]) -> list[bytes]:
        """Pieces' ids.  They are encoded as one text: cutting between them
        changes no token.  If the tokens are not that text's, its halves are
        looked at; one piece that its tokens do not spell is ``_BROKEN``."""
        text = "".join(pieces)
        raw = text.encode()
        a_ids, a_ends = self._a_tokens(text, raw)
        b_ids, b_ends = self._b_tokens(text)
        bounds = np.cumsum(np.fromiter((len(p.encode()) for p in pieces), np.int64, len(pieces)))
        a_to, b_to = np.searchsorted(a_ends, bounds) + 1, np.searchsorted(b_ends, bounds) + 1
        whole = (a_to[-1] == len(a_ids) and b_to[-1] == len(b_ids) and (a_ends[a_to - 1] == bounds).all()
                 and (b_ends[b_to - 1] == bounds).all() and b"".join(map(self.a_bytes.__getitem__, a_ids.tolist())) == raw
                 and b"".join(map(self.b_bytes.__getitem__, b_ids.tolist())) == raw)
        if not whole:
            half = len(pieces) // 2
            return self._packed(pieces[:half]) + self._packed(pieces[half:]) if half else [np.uint32(_BROKEN).tobytes()]
        a_n = np.diff(a_to, prepend=0)
        b_first = np.concatenate(([0], b_to[:-1]))
        numbers = np.empty(len(pieces) + len(a_ids) + len(b_ids), np.uint32)
        heads = np.arange(len(pieces)) + np.concatenate(([0], a_to[:-1])) + b_first
        numbers[heads] = a_n
        numbers[np.arange(len(a_ids)) + np.repeat(np.arange(1, len(pieces) + 1) + b_first, a_n)] = a_ids
        numbers[np.arange(len(b_ids)) + np.repeat(np.arange(1, len(pieces) + 1) + a_to, np.diff(b_to, prepend=0))] = b_ids
        data, at = numbers.tobytes(), (4 * heads).tolist()
        return [data[i:j] for i, j in zip(at, [*at[1:], len(data)])]

    def _encode(self, pieces: list[str]) -> list[bytes]:
        """A piece that ends in white space, or has the letter that B shows
        spaces as, is encoded alone."""
        alone = [p[-1].isspace() or "▁" in p for p in pieces]
        joined = [p for p, x in zip(pieces, alone) if not x]
        found: list[bytes] = []
        for k in range(0, len(joined), JOINED):
            found += self._packed(joined[k:k + JOINED])
        rest = iter(found)
        return [self._packed([p])[0] if x else next(rest) for p, x in zip(pieces, alone)]

    def __call__(self, column: pa.Array) -> tuple[np.ndarray, ...]:
        """For texts, or "" for none: A's ids, each one's text, B's ids, each
        one's text; of whole texts only."""
        data, offsets = text_bytes(column)
        none = np.zeros(0, np.int64)
        if not len(data):
            return none, none, none, none
        cuts = piece_cuts(data, offsets)
        pieces = pa.Array.from_buffers(pa.large_string(), len(cuts) - 1, [
            None, pa.py_buffer(cuts.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))]).dictionary_encode()
        index, words = pieces.indices.to_numpy(zero_copy_only=False), pieces.dictionary.to_pylist()
        got = list(map(self.known.get, words))
        missing = [i for i, x in enumerate(got) if x is None]
        packed = self._encode([words[i] for i in missing])
        for i, x in zip(missing, packed):
            got[i] = x
        room = self.keep - len(self.known)
        if room > 0:
            self.known.update((words[i], x) for i, x in zip(missing[:room], packed))
        flat = np.frombuffer(b"".join(got), np.uint32).astype(np.int64)
        length = np.fromiter(map(len, got), np.int64, len(got)) // 4
        first = np.cumsum(length) - length
        a_n = flat[first]
        text = np.searchsorted(offsets, cuts[:-1], side="right") - 1
        broken = np.zeros(len(offsets), bool)
        broken[text[(a_n == _BROKEN)[index]]] = True
        index, text = index[~broken[text]], text[~broken[text]]
        a, a_ends = _gathered(flat, first + 1, a_n, index)
        b, b_ends = _gathered(flat, first + 1 + a_n, length - 1 - a_n, index)
        return a, np.repeat(text, np.diff(a_ends, prepend=0)), b, np.repeat(text, np.diff(b_ends, prepend=0))


@functools.lru_cache(maxsize=2)
def pair_encoder(byte_level_path: str, sentence_path: str) -> PairEncoder:
    return PairEncoder(byte_level_path, sentence_path)


def align_texts(docs: DataFrame, byte_level_path: str | None = None, sentence_path: str | None = None,
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Alignment of each whole text, a space before it, as one row.

    ``doc_id``, ``row`` (tells repeated rows apart), ``n_a``, ``n_b``,
    ``n_groups`` and ``n_links``; ``groups``, the ids between offsets at which
    tokens of both kinds end, as ``a1,a2|b1;a3|b2,b3``; ``links``, the
    different linked id pairs in order (``pair``: ``a << 32 | b``) with the
    number of links of each (``times``).

    Null and empty texts, and texts that the tokens of A or B do not spell,
    have zeros, an empty ``groups`` and no pairs.  Strings of special tokens
    are ordinary text; a null id stays null; repeated rows give repeated rows;
    an empty table gives an empty result; other columns are not read.  A task
    holds about ``SLICE_BYTES`` of texts at a time, or one text if that is
    longer, at some hundred bytes for each token.
    """
    a_path, b_path = default_paths()
    a_path, b_path = byte_level_path or a_path, sentence_path or b_path

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = pair_encoder(a_path, b_path)
        row = TaskContext.get().partitionId() << 40
        for batch in slices(batches, "text", SLICE_BYTES):
            text = pc.fill_null(batch.column("text").cast(pa.large_string()), "")
            spaced = pc.if_else(pc.equal(pc.binary_length(text), 0), "",
                                pc.binary_join_element_wise(pa.scalar(" ", pa.large_string()), text, pa.scalar("", pa.large_string())))
            out = _aligned(encoder, spaced)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.arange(row, row + batch.num_rows)), *out],
                names=["doc_id", "row", "n_a", "n_b", "n_groups", "n_links", "groups", "links"])
            row += batch.num_rows

    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return own.mapInArrow(run, "doc_id long, row long, n_a long, n_b long, n_groups long, n_links long, "
                               "groups string, links array<struct<pair: long, times: long>>")


def _aligned(encoder: PairEncoder, spaced: pa.Array) -> list[pa.Array]:
    """The columns of :func:`align_texts` for texts with a space before them."""
    a_ids, a_text, b_ids, b_text = encoder(spaced)
    texts, size = len(spaced), encoder.size
    a_ends, b_ends = np.cumsum(encoder.a_sizes[a_ids]), np.cumsum(encoder.b_sizes[b_ids])
    total = int(a_ends[-1]) if len(a_ends) else 0
    a_cut, b_cut = np.zeros(total + 1, bool), np.zeros(total + 1, bool)
    a_cut[a_ends] = b_cut[b_ends] = True
    cuts = np.flatnonzero(a_cut | b_cut)
    link_a, link_b = (np.cumsum(cut[cuts]) - cut[cuts] for cut in (a_cut, b_cut))
    link_text = a_text[link_a]
    group_text = a_text[b_cut[a_ends]]

    # the groups' text: A's tokens move behind the B tokens of earlier groups, and the other way round
    a_last, b_last = b_cut[a_ends], a_cut[b_ends]
    a_group, b_group = np.cumsum(a_last) - a_last, np.cumsum(b_last) - b_last
    b_by, a_by = np.flatnonzero(b_last) + 1, np.flatnonzero(a_last) + 1
    order = np.empty(len(a_ids) + len(b_ids), np.int64)
    order[np.arange(len(a_ids)) + np.concatenate(([0], b_by))[a_group]] = a_ids + size * a_last
    order[np.arange(len(b_ids)) + a_by[b_group]] = b_ids + 2 * size * b_last
    spelled = encoder.shown.take(pa.array(order))
    at = np.frombuffer(spelled.buffers()[1], np.int64, len(spelled) + 1, 8 * spelled.offset)
    letters = memoryview(spelled.buffers()[2] or b"")
    first = np.searchsorted(a_text, np.arange(texts + 1)) + np.searchsorted(b_text, np.arange(texts + 1))
    bounds = at[first].tolist()
    groups = [bytes(letters[i:j - 1]) if j > i else b"" for i, j in zip(bounds[:-1], bounds[1:])]

    # each text's different pairs, and how often each is linked
    pair = a_ids[link_a] << 32 | b_ids[link_b]
    ranked = np.lexsort((pair, link_text))
    pair, text = pair[ranked], link_text[ranked]
    new = np.ones(len(pair), bool)
    new[1:] = (pair[1:] != pair[:-1]) | (text[1:] != text[:-1])
    at_new = np.flatnonzero(new)
    lists = pa.array(np.searchsorted(text[new], np.arange(texts + 1)).astype(np.int32))
    return [pa.array(np.bincount(a_text, minlength=texts)), pa.array(np.bincount(b_text, minlength=texts)),
            pa.array(np.bincount(group_text, minlength=texts)), pa.array(np.bincount(link_text, minlength=texts)),
            pa.array(groups, pa.binary()).cast(pa.string()),
            pa.ListArray.from_arrays(lists, pa.StructArray.from_arrays(
                [pa.array(pair[new]), pa.array(np.diff(np.concatenate((at_new, [len(pair)]))))], names=["pair", "times"]))]


def pair_weights(aligned: DataFrame) -> DataFrame:
    """``pair``, ``n`` (how many rows hold it linked) and ``best`` (whether no
    pair of its A id has more), from the ``links`` of all rows.  Counted in
    tasks first, so a pair of every row costs one row a task."""
    counts = materialize(aligned.select(F.explode("links.pair").alias("pair")).groupBy("pair").agg(F.count("*").alias("n")),
                         "alignment-counts")
    token = F.shiftright("pair", 32)
    highest = counts.groupBy(token.alias("a")).agg(F.max("n").alias("highest"))
    return materialize(counts.join(highest, token == F.col("a")).select("pair", "n", (F.col("n") == F.col("highest")).alias("best")),
                       "alignment-weights")


def score_links(aligned: DataFrame, max_bytes: int = BROADCAST_MAX_BYTES, share: float = FREQUENT_SHARE) -> DataFrame:
    """``aligned`` (a table with ``row`` and ``links``) with
    ``n_best``, the links whose pair has its A id's highest count, and
    ``count_sum``, the sum of the counts of all links.

    The pairs' counts are broadcast if they measure ``max_bytes`` at most.
    Beyond that, those of pairs in more than ``share`` of the rows are (at most
    1 / ``share`` times the mean number of a row's different pairs), and the
    other pairs, of which none is in more rows, are joined by shuffling.
    """
    weights = pair_weights(aligned)
    links = aligned.select("row", F.explode("links").alias("x")).select("row", "x.pair", "x.times")

    def sums(rows: DataFrame) -> DataFrame:
        return rows.groupBy("row").agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
                                       F.sum(F.col("times") * F.col("n")).alias("count_sum"))

    if measured_bytes(weights) <= max_bytes:
        scored = sums(links.join(F.broadcast(weights), "pair"))
    else:
        often = weights.filter(F.col("n") > share * aligned.count())
        marked = links.join(F.broadcast(often), "pair", "left")
        rest = marked.filter("n IS NULL").select("row", "pair", "times").join(weights, "pair")
        scored = sums(marked.filter("n IS NOT NULL")).unionByName(sums(rest)) \
            .groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    scored = scored.withColumnRenamed("row", "row_")
    return aligned.join(scored, F.col("row") == F.col("row_"), "left").drop("row_") \
        .withColumn("n_best", F.coalesce("n_best", F.lit(0)).cast("long")) \
        .withColumn("count_sum", F.coalesce("count_sum", F.lit(0)).cast("long"))
