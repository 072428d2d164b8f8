"""Language identification: known words first, then backoff to shorter character n-grams.

A word is a maximal run of letters, read in lower case.  A word of the learned
vocabulary adds its log frequency in each language.  An unseen word adds the
mean over its letters of the log frequency of the longest learned n-gram that
ends there, from 5 characters down to 1, with the word's edges as characters.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from heirloom.llm import kernels as K
from heirloom.llm.common import add_columns, batches_of, small_batches, trimmed

MAX_GRAM = 5


@cache
def letters() -> tuple[np.ndarray, np.ndarray]:
    """Of every code point: whether it is a letter, and the hash of its lower case (0 if it is none)."""
    is_letter = np.zeros(0x110000, bool)
    lower = np.arange(0x110000, dtype=np.uint64)
    for i in range(0x110000):
        c = chr(i)
        if c.isalpha():
            is_letter[i] = True
            small = c.lower()
            lower[i] = ord(small[0]) if small else i
    return is_letter, np.where(is_letter, K.mix(lower + np.uint64(77)), np.uint64(12345))


class _Words:
    """The words of some texts: hash, document, and a way to their n-grams."""

    def __init__(self, points: list[bytes]):
        is_letter, value = letters()
        sep = " ".encode("utf-32-le")
        c = np.frombuffer(sep + sep.join(points) + sep, np.uint32)
        edge = np.diff(is_letter[c].view(np.int8), prepend=np.int8(0))
        self.start, self.end = np.nonzero(edge == 1)[0], np.nonzero(edge == -1)[0]
        self.g = K.prefix_sums(value[c])
        _, self.ip = K.powers(len(self.g))
        self.hash = K.span_hashes(self.g, self.start, self.end)
        ends = np.cumsum([1] + [len(p) // 4 + 1 for p in points])
        self.counts = np.diff(np.searchsorted(self.start, ends))

    def gram_ends(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For chosen words: places just after each of their letters and of their right edge, the number of
        characters (edge included) up to there, and the index of the word among the chosen."""
        n = self.end[which] - self.start[which] + 1
        at = K.ragged(self.start[which] + 1, n)
        return at, K.ragged(np.full(len(n), 2), n), np.repeat(np.arange(len(n)), n)

    def grams(self, at: np.ndarray, n: int) -> np.ndarray:
        """The hash of the ``n`` characters before each place."""
        return K.mix((self.g[at] - self.g[at - n]) * self.ip[at - n] + np.uint64(n))


def _points(texts: list[str | None], limit: int = 1 << 22) -> Iterator[tuple[int, int, list[bytes]]]:
    blobs = [(t or "").encode("utf-32-le") for t in texts]
    for lo, hi in batches_of(blobs, limit):
        yield lo, hi, blobs[lo:hi]


@dataclass
class _Table:
    """Log frequencies of learned hashes, one column per language, found by a hash index."""

    hashes: np.ndarray
    scores: np.ndarray

    def __post_init__(self) -> None:
        self.index = K.HashIndex(self.hashes)

    def __reduce__(self):
        return _Table, (self.hashes, self.scores)

    def find(self, h: np.ndarray) -> np.ndarray:
        """The row of each hash, or -1."""
        return self.index.find(h)


@dataclass
class Model:
    """Languages and, by order (0: words), their tables."""

    langs: list[str]
    tables: dict[int, _Table]

    def scores(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Summed log frequencies per text and language, and the number of words of each text."""
        total, words = np.zeros((len(texts), len(self.langs))), np.zeros(len(texts), np.int64)
        for lo, hi, points in _points(texts):
            w = _Words(points)
            words[lo:hi] = w.counts
            if not len(w.start) or not self.langs:
                continue
            row = self.tables[0].find(w.hash)
            each = np.empty((len(row), len(self.langs)), np.float32)
            known = row >= 0
            each[known] = self.tables[0].scores[row[known]]
            if not known.all():
                each[~known] = self._unseen(w, np.nonzero(~known)[0])
            full = w.counts > 0
            begin = np.cumsum(w.counts) - w.counts
            sums = np.add.reduceat(each.astype(np.float64), begin[full], axis=0)
            total[lo:hi][full] = sums
        return total, words

    def _unseen(self, w: _Words, which: np.ndarray) -> np.ndarray:
        out = np.zeros((len(which), len(self.langs)), np.float32)
        # An unseen word often repeats: score each once.
        _, first, back = np.unique(w.hash[which], return_index=True, return_inverse=True)
        at, have, of = w.gram_ends(which[first])
        score = np.full((len(at), len(self.langs)), np.log(1e-6), np.float32)
        open_ = np.arange(len(at))
        for n in range(MAX_GRAM, 0, -1):
            fits = have[open_] >= n
            row = np.full(len(open_), -1, np.int64)
            row[fits] = self.tables[n].find(w.grams(at[open_[fits]], n))
            hit = row >= 0
            score[open_[hit]] = self.tables[n].scores[row[hit]]
            open_ = open_[~hit]
        n = w.end[which[first]] - w.start[which[first]] + 1
        out = np.add.reduceat(score, np.cumsum(n) - n, axis=0) / n[:, None] if len(n) else out
        return out[back]

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """The likeliest language of each text and its share; ``und`` and 0 for a text without letters."""
        total, words = self.scores(texts)
        if not self.langs:
            return ["und"] * len(texts), np.zeros(len(texts))
        best = total.argmax(axis=1)
        # Words are far from independent: their evidence counts by the root of their number.
        z = (total - total.max(axis=1, keepdims=True)) / np.sqrt(np.maximum(words, 1))[:, None]
        share = 1 / np.exp(z).sum(axis=1)
        return [self.langs[b] if n else "und" for b, n in zip(best, words, strict=True)], np.where(words > 0, share, 0.0)


def held_out(key: str = "doc_id"):
    """The documents that are never learned from: crc32 of the key as text is 2 modulo 4."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(
    docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", per_lang: int = 2000, min_count: int = 2
) -> Model:
    """Learn from about ``per_lang`` documents a language, chosen by a hash of the key, never held-out ones.

    That bound also bounds the model whatever the size of the input: it holds all
    words and n-grams that occur ``min_count`` times in the chosen documents, and
    all their characters.  Whole texts count.  Rows without text or label are left
    out; rows without a key are chosen like others.  Returns a model without
    languages if nothing is left.
    """
    d = docs.select(F.col(key).alias("k"), F.col(text).alias("text"), F.col(lang).cast("string").alias("lang")).where("text is not null and lang is not null")
    d = d.where(~held_out("k"))
    counts = {r["lang"]: r["count"] for r in d.groupBy("lang").count().collect()}
    langs = sorted(counts)
    if not langs:
        return Model([], {n: _Table(np.zeros(0, np.uint64), np.zeros((0, 0), np.float32)) for n in range(MAX_GRAM + 1)})
    share = F.create_map(*[x for name in langs for x in (F.lit(name), F.lit(min(1.0, per_lang / counts[name])))])
    # Rows without a key, and rows that share one, are told apart by their texts.
    luck = F.pmod(F.xxhash64("k", "text", F.lit("sample")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    sample = d.where(luck < share[F.col("lang")]).select("text", "lang")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text"):
            names, texts = batch.column("lang").to_pylist(), batch.column("text").to_pylist()
            for name in sorted(set(names)):
                for _, _, points in _points([t for t, n in zip(texts, names, strict=True) if n == name]):
                    w = _Words(points)
                    orders = [(0, w.hash)]
                    at, have, _ = w.gram_ends(np.arange(len(w.start)))
                    orders += [(n, w.grams(at[have >= n], n)) for n in range(1, MAX_GRAM + 1)]
                    for n, h in orders:
                        value, times = np.unique(h, return_counts=True)
                        if len(value):
                            yield pa.RecordBatch.from_pydict(
                                {"lang": [name] * len(value), "n": pa.array([n] * len(value), pa.int32()), "h": pa.array(value.view(np.int64)), "c": pa.array(times, pa.int64())}
                            )

    each = sample.mapInArrow(trimmed(count), "lang string, n int, h long, c long")
    wide = each.groupBy("n", "h").agg(F.sum("c").alias("total"), *[F.sum(F.when(F.col("lang") == name, F.col("c")).otherwise(0)).alias(f"l{i}") for i, name in enumerate(langs)])
    # Bounded by the chosen documents.
    rows = wide.where((F.col("total") >= min_count) | (F.col("n") == 1)).drop("total").toPandas()
    tables = {}
    for n in range(MAX_GRAM + 1):
        part = rows[rows.n == n]
        h = part.h.to_numpy(np.int64).view(np.uint64)
        order = np.argsort(h)
        c = part[[f"l{i}" for i in range(len(langs))]].to_numpy(np.float64)[order]
        smooth = (c + 0.5) / (c.sum(axis=0, keepdims=True) + 0.5 * (len(c) + 1))
        tables[n] = _Table(h[order], np.log(smooth).astype(np.float32))
    return Model(langs, tables)


def identify(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Add ``lang_pred`` and ``score`` to every row; input columns of these names are replaced.

    Reads the text alone.  A null text, or one without letters, is ``und`` with
    score 0, as is every text if the model knows no language.  Of languages that
    are equally likely the first by code point is taken.
    """

    def compute(texts: pa.Array) -> list[pa.Array]:
        name, share = model.predict(texts.to_pylist())
        return [pa.array(name, pa.string()), pa.array(share, pa.float64())]

    return add_columns(docs, text, {"lang_pred": T.StringType(), "score": T.DoubleType()}, compute)
