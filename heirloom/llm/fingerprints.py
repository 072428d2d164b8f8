"""Document fingerprints from modular prefix polynomial hashes.

``G[i] = sum((c[j] + 1) * B**j for j < i) mod p`` over the code points of a
text, for two primes below 2**31.  Any two spans compare in constant time, and
the longest common extension of two places is found by binary search.

A fingerprint keeps the prefix array itself, at places a power of two apart,
counted from the start and again from the end, besides the hash of the whole text
and the smallest hashes of all spans of 16 characters.  So two fingerprints answer
span equality at these places too.  Their likeness is the larger of (a) the share
of the longer text that the longest common prefix and suffix cover, found by
binary search over the places that both have, and (b) the bottom-k estimate of the
spans in common.  Beside it stand the exact extensions of the texts, by binary
search over their full prefix arrays.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from heirloom.llm.common import batches_of, column, small_batches, trimmed

PRIMES = (2147483647, 2147483629)
BASES = (1000003, 998244353)
#: A fingerprint has this many places at most, and more than half as many of a text that is long enough.
PLACES = 64
SPAN, SKETCH = 16, 16


class _Powers:
    """Powers of a base and of its inverse modulo a prime, grown by doubling."""

    def __init__(self, base: int, p: int):
        self.p = p
        self.tables = [(np.ones(1, np.uint64), base), (np.ones(1, np.uint64), pow(base, -1, p))]

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        while len(self.tables[0][0]) <= n:
            grown = []
            for t, b in self.tables:
                step = np.uint64(pow(b, len(t), self.p))
                grown.append((np.concatenate((t, t * step % np.uint64(self.p))), b))
            self.tables = grown
        return self.tables[0][0], self.tables[1][0]


_POWERS = [_Powers(b, p) for b, p in zip(BASES, PRIMES, strict=True)]


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), np.uint32)


class PrefixHashes:
    """Prefix arrays of one sequence of code points: span equality and longest common extensions."""

    def __init__(self, text: str | np.ndarray):
        c = code_points(text) if isinstance(text, str) else text
        self.n = len(c)
        values = c.astype(np.uint64) + np.uint64(1)
        self.g, self.inv = [], []
        for pw in _POWERS:
            p, (up, down) = np.uint64(pw.p), pw.get(self.n + 1)
            g = np.zeros(self.n + 1, np.uint64)
            np.cumsum(values * up[: self.n] % p, out=g[1:])
            self.g.append(g % p)
            self.inv.append(down)

    def spans(self, starts: np.ndarray, ends: np.ndarray, which: int = 0) -> np.ndarray:
        """Hash of each span under one prime, the same wherever the span stands."""
        p, g = np.uint64(PRIMES[which]), self.g[which]
        return (g[ends] + p - g[starts]) % p * self.inv[which][starts] % p

    def span(self, start: int, end: int) -> tuple[int, int]:
        s, e = np.array([start]), np.array([end])
        return int(self.spans(s, e, 0)[0]), int(self.spans(s, e, 1)[0])

    def lce(self, at: np.ndarray, there: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Length of the longest common extension of each pair of places, ``most`` at most."""
        return self._search(most, lambda n: (at, at + n, there, there + n))

    def lce_back(self, at: np.ndarray, there: np.ndarray, most: np.ndarray) -> np.ndarray:
        """The same to the left of each pair of places."""
        return self._search(most, lambda n: (at - n, at, there - n, there))

    def _search(self, most: np.ndarray, ends: Callable[[np.ndarray], tuple[np.ndarray, ...]]) -> np.ndarray:
        low, high = np.zeros(len(most), np.int64), most.astype(np.int64)
        while (low < high).any():
            mid = (low + high + 1) // 2
            a, b, c, d = ends(mid)
            same = (self.spans(a, b, 0) == self.spans(c, d, 0)) & (self.spans(a, b, 1) == self.spans(c, d, 1))
            low, high = np.where(same, mid, low), np.where(same, high, mid - 1)
        return low


def _sketch(hashes: np.ndarray) -> np.ndarray:
    """The smallest distinct hashes."""
    if len(hashes) > 8 * SKETCH:
        few = np.unique(np.partition(hashes, 4 * SKETCH)[: 4 * SKETCH])
        if len(few) >= SKETCH:
            return few[:SKETCH]
    return np.unique(hashes)[:SKETCH]


def _stride(n: np.ndarray) -> np.ndarray:
    """The least power of two that leaves ``PLACES`` places or fewer in ``n`` characters."""
    over = np.maximum(0, (n - 1) // PLACES)
    return np.int64(1) << np.ceil(np.log2(over + 1)).astype(np.int64)


def _batched(blobs: list[bytes], limit: int) -> Iterator[tuple[int, int, PrefixHashes, np.ndarray, np.ndarray]]:
    """Runs of UTF-32 texts with the prefix arrays of all, and where each begins and ends there."""
    for lo, hi in batches_of(blobs, 4 * limit):
        ends = np.cumsum([len(b) // 4 for b in blobs[lo:hi]], dtype=np.int64)
        starts = np.concatenate(([0], ends[:-1]))
        yield lo, hi, PrefixHashes(np.frombuffer(b"".join(blobs[lo:hi]), np.uint32)), starts, ends


def fingerprints(texts: list[str], limit: int = 1 << 20) -> list[str]:
    """The fingerprint of each text: length, whole hash, prefix array from the start, from the end, and sketch, in hexadecimal."""
    out: list[str] = []
    for _, _, ph, starts, ends in _batched([t.encode("utf-32-le") for t in texts], limit):
        lens = ends - starts
        whole = [ph.spans(starts, ends, k) for k in (0, 1)]
        stride = _stride(lens)
        places = lens // stride
        upto = np.cumsum(places)
        of = np.repeat(np.arange(len(lens)), places)
        step = (np.arange(len(of)) - np.repeat(upto - places, places) + 1) * stride[of]
        head = ph.spans(starts[of], starts[of] + step).astype(">u4")
        tail = ph.spans(ends[of] - step, ends[of]).astype(">u4")
        at = np.arange(max(0, ph.n - SPAN + 1))
        spans = ph.spans(at, at + SPAN, 1) if len(at) else at.astype(np.uint64)
        spans = spans * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(32)
        for i, (s, e) in enumerate(zip(starts.tolist(), ends.tolist(), strict=True)):
            r = slice(upto[i] - places[i], upto[i])
            low = _sketch(spans[s : max(s, e - SPAN + 1)]).astype(">u4").tobytes().hex()
            out.append(f"{e - s:x}:{whole[0][i]:08x}{whole[1][i]:08x}:{head[r].tobytes().hex()}:{tail[r].tobytes().hex()}:{low}")
    return out


def extensions(pairs: list[tuple[str, str]], limit: int = 1 << 20) -> list[tuple[int, int]]:
    """Of each pair of texts, the length of the longest common prefix, and of the longest common suffix of the rest."""
    out: list[tuple[int, int]] = []
    blobs = [(a + b).encode("utf-32-le") for a, b in pairs]
    for lo, hi, ph, starts, ends in _batched(blobs, limit):
        middle = starts + np.array([len(a) for a, _ in pairs[lo:hi]], np.int64)
        most = np.minimum(middle - starts, ends - middle)
        head = ph.lce(starts, middle, most)
        out += zip(head.tolist(), ph.lce_back(middle, ends, most - head).tolist(), strict=True)
    return out


def _agree(a: str, b: str, na: int, nb: int) -> int:
    """The longest common extension of two sampled prefix arrays of texts of ``na`` and ``nb`` characters, by binary search."""
    sa, sb = (int(_stride(np.int64(n))) for n in (na, nb))
    stride = max(sa, sb)
    at = lambda x, s, i: x[8 * (i * stride // s) - 8 : 8 * (i * stride // s)]  # noqa: E731  the prefix of i strides
    low, high = 0, min(na, nb) // stride
    while low < high:
        mid = (low + high + 1) // 2
        if at(a, sa, mid) == at(b, sb, mid):
            low = mid
        else:
            high = mid - 1
    return low * stride


def likeness(a: str, b: str) -> float:
    """How alike two fingerprints are, from 0 to 1; 1 only for equal ones."""
    if a == b:
        return 1.0
    ha, _, heada, taila, lowa = a.split(":")
    hb, _, headb, tailb, lowb = b.split(":")
    na, nb = int(ha, 16), int(hb, 16)
    covered = (_agree(heada, headb, na, nb) + _agree(taila, tailb, na, nb)) / max(na, nb)
    sa, sb = ({s[i : i + 8] for i in range(0, len(s), 8)} for s in (lowa, lowb))
    union = sorted(sa | sb)[:SKETCH]
    same = sum(x in sa and x in sb for x in union) / len(union) if union else 0.0
    return min(0.999, max(covered, same))


RESULT = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double, next_id long, common_prefix long, common_suffix long"
)


def _edit(text: str, following: str) -> str:
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _pairs_in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (doc_id, text, guest) in order: a row for every document, made with the one that follows it."""
    last: tuple[int | None, str, str] | None = None
    for batch in small_batches(batches, "text"):
        ids, texts = batch.column("doc_id").to_pylist(), [t or "" for t in batch.column("text").to_pylist()]
        guests = batch.column("guest").to_pylist()
        prints = fingerprints(texts)
        rows = [*([(*last, False)] if last else []), *zip(ids, texts, prints, guests, strict=True)]
        pairs = [(x, y) for x, y in zip(rows, rows[1:], strict=False) if not x[3]]
        edited = [_edit(x[1], y[1]) for x, y in pairs]
        eprints = fingerprints(edited)
        if pairs:
            common = extensions([(x[1], e) for (x, _), e in zip(pairs, edited, strict=True)])
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": pa.array([x[0] for x, _ in pairs], pa.int64()),
                    "n_chars": pa.array([len(x[1]) for x, _ in pairs], pa.int64()),
                    "edited_sha256": [hashlib.sha256(e.encode()).hexdigest() for e in edited],
                    "fingerprint": [x[2] for x, _ in pairs],
                    "edited_fingerprint": eprints,
                    "near_edited": [likeness(x[2], e) for (x, _), e in zip(pairs, eprints, strict=True)],
                    "near_next": [likeness(x[2], y[2]) for x, y in pairs],
                    "next_id": pa.array([y[0] for _, y in pairs], pa.int64()),
                    "common_prefix": pa.array([c[0] for c in common], pa.int64()),
                    "common_suffix": pa.array([c[1] for c in common], pa.int64()),
                }
            )
        # A guest ends its range: nothing is paired across it.
        last = None if guests[-1] else rows[-1][:3]


#: Ranges of keys at most; each is one sorted, streamed task.
MOST_RANGES = 16_384


def _slot_of(cuts: list[int]) -> Column:
    """How many of the sorted ``cuts`` are below ``doc_id``: first among every so manieth of them, then among those after it."""
    each = max(1, int(len(cuts) ** 0.5))
    blocks = [cuts[i : i + each] for i in range(0, len(cuts), each)]
    below = lambda xs: F.size(F.filter(xs, lambda b: b < F.col("doc_id")))
    block = F.greatest(below(F.lit([b[0] for b in blocks])), F.lit(1))
    return (block - 1) * each + below(F.element_at(F.lit(blocks), block))


def fingerprint_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", each: int = 2000) -> DataFrame:
    """Fingerprint every document, its edited text and the document that follows it.

    Returns ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next, next_id, common_prefix, common_suffix``, one row per
    row of ``docs``.  Documents follow one another by ``key``, rows of one key by
    text; rows without a key come last, in the order of a hash of their texts; the
    last document is followed by the first.  The edited text keeps the first half
    and takes the second from the start of the following document; the last two
    columns count the characters that it has in common with the text at the start
    and, of the rest, at the end.  A null text counts as empty.  Other columns of
    the input are not read.  One document alone follows itself; no document gives
    no row.

    Texts move once: rows are dealt out by ranges of keys between quantiles, and
    the first document of each range is also sent to the range before it.
    """
    d = docs.select(column(key).cast("long").alias("doc_id"), column(text).alias("text"))
    n, n_null = d.agg(F.count(F.lit(1)), F.count(F.when(F.col("doc_id").isNull(), 1))).first()
    if not n:
        return d.sparkSession.createDataFrame([], RESULT)
    ranges = max(1, min(MOST_RANGES, n // each))
    cuts = d.agg(F.percentile_approx("doc_id", [(i + 1) / ranges for i in range(ranges - 1)], 2 * MOST_RANGES)).first()[0] if ranges > 1 else None
    cuts = sorted({*(cuts or [])})
    slot = _slot_of([int(c) for c in cuts]) if cuts else F.lit(0)
    # Rows without a key: as many ranges of a hash as their number asks for.
    free = max(1, min(MOST_RANGES, n_null // each))
    late = F.lit(len(cuts) + 1) + F.pmod(F.xxhash64("text"), F.lit(free))
    d = d.withColumn("slot", F.when(F.col("doc_id").isNull(), late).otherwise(slot).cast("int"))
    # One row per range: what comes first there.
    first = F.min(F.struct("doc_id", F.coalesce("text", F.lit("")).alias("text")))
    if n_null:
        heads = d.groupBy("slot").agg(first.alias("o")).select("slot", "o.doc_id", "o.text")
    else:
        firsts = d.groupBy("slot").agg(F.min("doc_id").alias("doc_id"))
        heads = d.join(F.broadcast(firsts), ["slot", "doc_id"]).groupBy("slot", "doc_id").agg(F.min(F.coalesce("text", F.lit(""))).alias("text"))
    turn = Window.orderBy("slot")
    slots = heads.select("slot", F.lag("slot").over(turn).alias("before"), F.max("slot").over(Window.partitionBy()).alias("last"))
    guests = heads.join(F.broadcast(slots), "slot").select("doc_id", "text", F.coalesce("before", "last").alias("slot"), F.lit(True).alias("guest"))
    rows = d.withColumn("guest", F.lit(False)).unionByName(guests)
    parts = max(1, min(ranges + free, int(d.sparkSession.conf.get("spark.sql.shuffle.partitions")) * 2))
    return (
        rows.repartition(parts, "slot")
        .sortWithinPartitions("slot", "guest", F.col("doc_id").asc_nulls_last(), "text")
        .select("doc_id", "text", "guest")
        .mapInArrow(trimmed(_pairs_in_order), RESULT)
    )
