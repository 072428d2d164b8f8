"""Stupid-backoff language model scores from corpus-wide n-gram counts.

Every chunk of documents explodes its words into n-grams and keeps the distinct
ones with their counts.  The count tables are partitioned by hash: the bucket
that owns a hash range sums what all chunks counted, and the sums are joined back
to the chunks' n-grams, scored, and summed per document.  Rows of these relations
are packed: one holds all n-grams that a chunk and a bucket share.

A word's score is ``count(n-gram) / count(its first n-1 words)`` for the longest
n-gram that occurs elsewhere, times 0.4 for each word of context given up.  A
document's own occurrences are taken off the counts, so that it is scored by the
others.  One- and two-word n-grams are counted first.  An n-gram of three words or
more can occur in another document only if both its shorter ends do, so each
further order counts only those; the others have count 0 without being sent.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from heirloom.llm import exchange as X
from heirloom.llm import kernels as K
from heirloom.llm.common import as_bytes

BACKOFF = 0.4
_PLACES = K._splitmix(909, 8) | np.uint64(1)


class _Grams:
    """The words of a chunk's documents and their n-grams, by the word that an n-gram ends at."""

    def __init__(self, blobs: list[bytes]):
        self.words, self.counts = K.word_hashes(blobs)
        self.doc = np.repeat(np.arange(len(blobs), dtype=np.int32), self.counts)
        self.place = np.arange(len(self.words)) - np.repeat(np.cumsum(self.counts) - self.counts, self.counts)

    def fits(self, n: int) -> np.ndarray:
        """Where an n-gram does not begin before its document."""
        return self.place >= n - 1

    def hashes(self, n: int, where: np.ndarray) -> np.ndarray:
        w = self.words
        h = w * _PLACES[0]
        for k in range(1, n):
            h[k:] += w[: len(w) - k] * _PLACES[k]
        return K.mix(h[where] + np.uint64(n))

    def own(self, h: np.ndarray, where: np.ndarray) -> np.ndarray:
        """How often each n-gram at ``where`` occurs in its own document."""
        pair = K.mix(h ^ K.mix(self.doc[where].astype(np.uint64) + np.uint64(5)))
        order = np.argsort(pair, kind="stable")
        starts = K.group_starts(pair[order])
        width = np.diff(np.append(starts, len(order)))
        out = np.empty(len(order), np.int32)
        out[order] = np.repeat(width, width)
        return out


def _small(x: np.ndarray) -> bytes:
    """Counts as one byte each, with those above 254 after."""
    return np.minimum(x, 255).astype(np.uint8).tobytes() + x[x >= 255].astype(np.int64).tobytes()


def _counts(blob: bytes, n: int) -> np.ndarray:
    x = np.frombuffer(blob, np.uint8, n).astype(np.int64)
    x[x == 255] = np.frombuffer(blob[n:], np.int64)
    return x


def _totals(blobs: list[bytes]) -> list[bytes]:
    """The count table of a bucket, handed to each chunk for the n-grams it has."""
    values, counts, sizes = [], [], []
    for b in blobs:
        n = int(np.frombuffer(b, np.int64, 1)[0])
        values.append(X.unpack_sorted(b[8 : 8 + 8 * n], n))
        counts.append(_counts(b[8 + 8 * n :], n))
        sizes.append(n)
    v, c = np.concatenate(values), np.concatenate(counts)
    order = np.argsort(v, kind="stable")
    starts = K.group_starts(v[order])
    total = np.empty(len(v), np.int64)
    total[order] = np.repeat(np.add.reduceat(c[order], starts), np.diff(np.append(starts, len(v))))
    return [_small(x) for x in np.split(total, np.cumsum(sizes)[:-1])]


def _ask(h: np.ndarray, n: int, chunk: int, buckets: int) -> list[tuple[int, int, bytes]]:
    """The distinct n-grams of order ``n`` with their counts; every order has buckets of its own."""
    v, times = np.unique(h, return_counts=True)
    return [((n - 1) * buckets + b, chunk, np.int64(hi - lo).tobytes() + X.pack_sorted(v[lo:hi]) + _small(times[lo:hi])) for b, lo, hi in X.runs_by_bucket(v, buckets)]


def _others(g: _Grams, upto: int, mail: dict[int, bytes], buckets: int) -> list[np.ndarray]:
    """By order, how often the n-gram that ends at each word occurs in other documents; 0 where it does not fit or was not sent."""
    found: list[np.ndarray] = []
    for n in range(1, upto + 1):
        where = np.nonzero(_sent(g, n, found))[0]
        h = g.hashes(n, where)
        v, inverse = np.unique(h, return_inverse=True)
        total = np.zeros(len(v), np.int64)
        for b, lo, hi in X.runs_by_bucket(v, buckets):
            total[lo:hi] = _counts(mail[(n - 1) * buckets + b], hi - lo)
        out = np.zeros(len(g.words), np.int64)
        out[where] = total[inverse] - g.own(h, where)
        found.append(out)
    return found


def _sent(g: _Grams, n: int, found: list[np.ndarray]) -> np.ndarray:
    """Which n-grams of order ``n`` are counted, given the counts of lower orders."""
    fits = g.fits(n)
    if n > 2:
        known = found[n - 2] > 0
        fits &= known
        fits[1:] &= known[:-1]
    return fits


def score_documents(
    docs: DataFrame, key: str = "doc_id", text: str = "text", order: int = 3, carry: tuple[str, ...] = ("doc_id",), each: int = X.CHUNK
) -> DataFrame:
    """Mean log10 stupid-backoff score of the words of every document.

    Returns the columns ``carry`` and ``n_words``, ``n_seen`` (words whose
    longest n-gram occurs in another document), ``log_score`` (null without words).
    A word that no other document holds counts 0.4 / (words of the corpus + 1) on
    top of the backoff.  Words are split at ASCII whitespace and taken as they
    are.  A null text has no words.  Copies of a text count as other documents, as
    do rows that share a key, or have none; a row that equals another in key and
    text counts once more.  Input columns of the result's names are replaced.  An
    empty input gives an empty result.
    """
    carry = X.result_names(carry, {"n_words", "n_seen", "log_score"})
    d, buckets = X.chunked(docs, key, text, carry, each)

    def read(t: pa.Table) -> tuple[_Grams, int]:
        return _Grams(as_bytes(t.column("text"))), t.column("chunk")[0].as_py() if t.num_rows else -1

    def first(t: pa.Table) -> list[tuple[int, int, bytes]]:
        g, chunk = read(t)
        rows = [row for n in range(1, min(order, 2) + 1) for row in _ask(g.hashes(n, np.nonzero(g.fits(n))[0]), n, chunk, buckets)]
        # The size of the corpus travels like an n-gram of its own, to a bucket after the others.
        return [*rows, (order * buckets, chunk, np.int64(1).tobytes() + X.pack_sorted(np.zeros(1, np.uint64)) + _small(g.counts.sum(keepdims=True)))]

    def further(n: int):
        def ask(t: pa.Table, mail: dict[int, bytes]) -> pa.Table:
            g, chunk = read(t)
            where = np.nonzero(_sent(g, n, _others(g, n - 1, mail, buckets)))[0]
            return X.letters(_ask(g.hashes(n, where), n, chunk, buckets))

        return ask

    def score(t: pa.Table, mail: dict[int, bytes]) -> pa.Table:
        g, _ = read(t)
        size = len(g.counts)
        seen, logs = np.zeros(size, np.int64), np.zeros(size)
        if len(g.doc):
            by_order = _others(g, order, mail, buckets)
            everywhere = int(_counts(mail[order * buckets], 1)[0])
            value = np.full(len(g.doc), BACKOFF / (everywhere + 1))
            hit = by_order[0] > 0
            value[hit] = by_order[0][hit] / (everywhere - g.counts[g.doc[hit]])
            longest = hit.astype(np.int8)
            for n in range(2, order + 1):
                value[g.fits(n)] *= BACKOFF
                hit = by_order[n - 1] > 0
                hit[1:] &= by_order[n - 2][:-1] > 0
                at = np.nonzero(hit)[0]
                value[at] = by_order[n - 1][at] / by_order[n - 2][at - 1]
                longest[at] = n
            can = np.minimum(g.place + 1, order)
            seen = np.bincount(g.doc, weights=longest == can, minlength=size).astype(np.int64)
            logs = np.bincount(g.doc, weights=np.log10(value), minlength=size)
        mean = [x / n if n else None for x, n in zip(logs.tolist(), g.counts.tolist(), strict=True)]
        new = {"n_words": pa.array(g.counts, pa.int64()), "n_seen": pa.array(seen, pa.int64()), "log_score": pa.array(mean, pa.float64())}
        return pa.table({f"c{i}": t.column(f"c{i}") for i in range(len(carry))} | new)

    totals = X.answer(X.send(d, first), _totals)
    for n in range(3, order + 1):
        totals = totals.union(X.answer(X.meet(d, totals, further(n), X.LETTER), _totals))
    return X.named(X.meet(d, totals, score, X.carried(docs, carry) + "n_words long, n_seen long, log_score double"), carry)
