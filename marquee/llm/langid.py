"""Language identification by words first, character n-grams after.

A word that the model knows adds its log frequency in each language.  A word
that it does not know falls back: the longest n-grams of the word of which any
is known add the mean of their log frequencies, from ``max_n`` characters down
to single ones.  Words without any known character add nothing.

The model is fitted on a bounded sample of labelled texts: about
``sample_docs`` different texts of each language, chosen by a hash of the text,
and at most ``max_words`` words and ``max_grams`` n-grams, the most frequent
ones.  These bounds are parameters; prediction reads every text whole.  The
model knows its terms by 64-bit hashes, in sorted arrays: a worker holds no
text of them.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from marquee.llm.text_arrow import slices, text_bytes
from marquee.session import materialize

UNKNOWN = "und"
SLICE_BYTES = 1 << 20
_WORD = re.compile(r"[^\W\d_]+")


_random = np.random.default_rng(20261203)
_BYTE = _random.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0xD1342543DE82EF95)


def term_keys(terms: list[str]) -> np.ndarray:
    """64-bit hashes of terms, none of which is empty."""
    data, offsets = text_bytes(pa.array(terms, pa.string()))
    if not len(data):
        return np.zeros(0, np.uint64)
    size = np.diff(offsets)
    powers = np.full(int(size.max()), _BASE, np.uint64)
    powers[0] = 1
    np.multiply.accumulate(powers, out=powers)
    place = np.arange(len(data)) - np.repeat(offsets[:-1], size)
    x = np.add.reduceat(_BYTE[data] * powers[place], offsets[:-1]) + size.astype(np.uint64)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def _places(keys: np.ndarray, terms: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Where terms are in sorted keys, and which of them are there."""
    own = term_keys(terms)
    if not len(keys):
        return np.zeros(len(own), np.int64), np.zeros(len(own), bool)
    at = np.minimum(np.searchsorted(keys, own), len(keys) - 1)
    return at, keys[at] == own


@dataclass
class Model:
    """Log frequencies: the sorted ``words``, then the sorted ``grams`` are the
    rows of ``table``, which has a column for each of ``langs``."""
    langs: list[str]
    words: np.ndarray
    grams: np.ndarray
    table: np.ndarray
    max_n: int


def fit(labelled: DataFrame, sample_docs: int = 4000, max_words: int = 200_000,
        max_grams: int = 200_000, max_n: int = 4, smoothing: float = 0.5, max_langs: int = 200) -> Model:
    """Fit on ``text`` and ``lang``; rows with a null in either are left out,
    and copies of a text in a language count once.

    What comes to the driver is one row for each language, and at most
    ``max_words`` + ``max_grams`` counts.  More than ``max_langs`` different
    labels are an error: the model has a column for each.  An empty table
    gives a model without languages.
    """
    rows = labelled.select(F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")).dropna()
    rows = rows.withColumn("copy", F.xxhash64("text"))
    sizes = {r["lang"]: r["count"] for r in rows.select("lang", "copy").distinct().groupBy("lang").count()
             .limit(max_langs + 1).collect()}
    if len(sizes) > max_langs:
        raise ValueError(f"more than {max_langs} languages: clean the labels, or raise max_langs")
    langs = sorted(sizes)
    if not langs:
        return Model([], np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros((0, 0)), max_n)
    share = F.create_map(*[F.lit(x) for lang in langs for x in (lang, min(1.0, sample_docs / sizes[lang]))])
    sample = rows.filter(F.pmod("copy", F.lit(1 << 20)) < share[F.col("lang")] * (1 << 20)).dropDuplicates(["lang", "copy"])
    words = materialize(
        sample.select("lang", F.explode(F.regexp_extract_all(F.lower("text"), F.lit(r"(\p{L}+)"), 1)).alias("term"))
        .groupBy("lang", "term").count(), "language-words")
    padded = F.concat(F.lit(" "), "term", F.lit(" "))
    spans = F.flatten(F.transform(F.sequence(F.lit(1), F.lit(max_n)), lambda n: F.transform(
        F.sequence(F.lit(1), F.greatest(F.length(padded) - n + 1, F.lit(1))), lambda i: padded.substr(i, n))))
    grams = (words.select("lang", "count", F.explode(spans).alias("term"))
             .groupBy("lang", "term").agg(F.sum("count").alias("count")))

    def top(counts: DataFrame, n: int) -> tuple[dict[str, int], np.ndarray]:
        best = counts.orderBy(F.desc("count"), "term", "lang").limit(n).select("term", "lang", "count").toArrow()
        rows = list(zip(*(best.column(c).to_pylist() for c in ("term", "lang", "count"))))
        index: dict[str, int] = {}
        for term, _, _ in rows:
            index.setdefault(term, len(index))
        table = np.full((len(index), len(langs)), smoothing)
        at = {lang: i for i, lang in enumerate(langs)}
        for term, lang, count in rows:
            table[index[term], at[lang]] += count
        return index, table

    def logs(index: dict[str, int], table: np.ndarray) -> np.ndarray:
        """Log frequency among the terms of the same length class."""
        out = np.zeros_like(table)
        for n in {len(t) for t in index}:
            own = np.array([i for t, i in index.items() if len(t) == n])
            out[own] = np.log(table[own] / table[own].sum(axis=0))
        return out

    word_index, word_table = top(words, max_words)
    gram_index, gram_table = top(grams, max_grams)
    total = word_table.sum(axis=0)
    words_, grams_ = term_keys(list(word_index)), term_keys(list(gram_index))
    by_word, by_gram = np.argsort(words_), np.argsort(grams_)
    table = np.vstack([(np.log(word_table / total) if len(word_index) else word_table)[by_word],
                       logs(gram_index, gram_table)[by_gram]])
    return Model(langs, words_[by_word], grams_[by_gram], table, max_n)


class Scorer:
    """Scores texts.  Known words are looked up in the model itself; at most
    ``keep`` unseen words of a worker are remembered besides."""

    def __init__(self, model: Model, keep: int = 50_000):
        self.model, self.keep = model, keep
        self.unseen: dict[str, int] = {}
        self.rows = np.zeros((1024, len(model.langs)))  # of unseen words; grown by doubling

    @staticmethod
    def of(model: Model) -> "Scorer":
        """The one scorer of a worker's model."""
        if not hasattr(model, "scorer"):
            model.scorer = Scorer(model)
        return model.scorer

    def _fallback(self, words: list[str]) -> np.ndarray:
        m = self.model
        out, left = np.zeros((len(words), len(m.langs))), list(range(len(words)))
        for n in range(m.max_n, 0, -1):
            grams, owners = [], []
            for i in left:
                padded = f" {words[i]} "
                own = [g for j in range(len(padded) - n + 1) if (g := padded[j:j + n]) != " "]
                grams.extend(own)
                owners.extend([i] * len(own))
            at, known = _places(m.grams, grams)
            owner = np.array(owners, np.int64)[known]
            np.add.at(out, owner, m.table[len(m.words) + at[known]])
            count = np.bincount(owner, minlength=len(words))
            out[count > 0] /= count[count > 0, None]
            left = [i for i in left if not count[i]]
            if not left:
                break
        return out

    def _learn(self, words: list[str]) -> None:
        if len(self.unseen) + len(words) > self.keep:
            self.unseen = {}
        need = len(self.unseen) + len(words)
        if need > len(self.rows):
            grown = np.zeros((max(need, 2 * len(self.rows)), self.rows.shape[1]))
            grown[:len(self.unseen)] = self.rows[:len(self.unseen)]
            self.rows = grown
        self.rows[len(self.unseen):need] = self._fallback(words)
        for w in words:
            self.unseen[w] = len(self.unseen)

    def one(self, text: str | None) -> tuple[str, float]:
        counts = Counter(_WORD.findall(text.lower())) if text else Counter()
        if not self.model.langs or not any(ch.isalpha() for w in counts for ch in w):
            return UNKNOWN, 0.0
        total, found = np.zeros(len(self.model.langs)), list(counts)
        at, known = _places(self.model.words, found)
        if known.any():
            total += np.fromiter(counts.values(), float, len(found))[known] @ self.model.table[at[known]]
        new = [w for w, k in zip(found, known.tolist()) if not k]
        for k in range(0, len(new), 4096):  # a long text may have more words than are kept
            own = new[k:k + 4096]
            missing = [w for w in own if w not in self.unseen]
            if missing and len(self.unseen) + len(missing) > self.keep:
                missing = own  # all is forgotten first
            if missing:
                self._learn(missing)
            total += np.array([counts[w] for w in own], float) @ self.rows[[self.unseen[w] for w in own]]
        best = int(total.argmax())  # the first of equal ones: languages are in order
        return self.model.langs[best], float(1 / np.exp(np.minimum(total - total[best], 0)).sum())

    def batch(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        found = [self.one(t) for t in texts]
        return [f[0] for f in found], [f[1] for f in found]


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` (the posterior share of that
    language, 0 to 1) added; columns of those names are replaced.

    Only ``text`` decides.  A null text, or one without a letter, is ``und``
    with score 0, as is everything if no language was learned.  Ties go to the
    first language in order.  Every text is read whole; a task holds one slice
    of texts, or one text if that is longer.  Repeated rows give repeated rows,
    an empty table an empty result.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by max_words + max_grams
    others = docs.drop("lang_pred", "score")
    out = StructType([*others.schema.fields, StructField("lang_pred", StringType()), StructField("score", DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer.of(shared.value)
        for batch in slices(batches, "text", SLICE_BYTES):
            langs, scores = scorer.batch(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                names=[*batch.schema.names, "lang_pred", "score"])

    return others.mapInArrow(run, out)


def held_out(doc_id: str = "doc_id"):
    """Whether a document's label is kept from the model: crc32 of the id as
    text, modulo 3, is 1.  A document without an id is not held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))
