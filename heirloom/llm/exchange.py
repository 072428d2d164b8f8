"""Question and answer between chunks of documents and buckets of hashes.

Documents are dealt out once into chunks of bounded size.  A chunk sends what
it wants to know of the whole corpus to buckets that each own a range of a
64-bit hash, as packed columns and without repeats, so that a value that occurs
in a third of all documents costs a bucket one entry per chunk.  The answers go
back to the chunks, which meet them beside their texts in a cogroup.  All
rounds of an operator read the same exchange of texts, which Spark plans once.
Nothing reaches the driver, and no task holds more than a chunk or a bucket.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from heirloom.llm.common import column, in_slices, parts_for, total_bytes, trim
from heirloom.llm.kernels import group_starts

#: Bytes of text in a chunk.
CHUNK = 8 << 20
LETTER = "bucket int, chunk int, blob binary"
_CODEC = pa.Codec("zstd", compression_level=1)


def chunked(docs: DataFrame, key: str, text: str, carry: tuple[str, ...], each: int = CHUNK) -> tuple[DataFrame, int]:
    """``chunk, key, text, c0, c1, ...`` (the columns to carry, whatever their names), and the number of chunks.

    Rows are dealt by key and text together, so that rows of one key, or of none, spread like others.
    """
    d = docs.select(column(key).cast("long").alias("key"), column(text).alias("text"), *[column(c).alias(f"c{i}") for i, c in enumerate(carry)])
    n_bytes = total_bytes(d, "text")
    n = max(parts_for(n_bytes, each), min(48, parts_for(n_bytes, 1 << 18)))
    return d.withColumn("chunk", F.pmod(F.xxhash64("key", "text"), F.lit(n)).cast("int")), n


def carried(docs: DataFrame, carry: tuple[str, ...]) -> str:
    """The schema of the carried columns under their working names."""
    return "".join(f"c{i} {docs.select(column(c)).dtypes[0][1]}, " for i, c in enumerate(carry))


def named(found: DataFrame, carry: tuple[str, ...]) -> DataFrame:
    """Carried columns under their own names, then the results."""
    return found.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(carry)], *found.columns[len(carry) :])


def result_names(carry: tuple[str, ...], new: set[str]) -> tuple[str, ...]:
    """The columns to carry beside results of the names ``new``; names are compared as Spark does, without case."""
    return tuple(dict.fromkeys(c for c in carry if c.lower() not in new))


def bucket_of(values: np.ndarray, n: int) -> np.ndarray:
    """Which of ``n`` equal hash ranges each value lies in."""
    return ((values >> np.uint64(32)) * np.uint64(n) >> np.uint64(32)).astype(np.int64)


def runs_by_bucket(values: np.ndarray, n: int) -> list[tuple[int, int, int]]:
    """Bucket, begin and end of each run of sorted ``values``; buckets without any do not appear."""
    b = bucket_of(values, n)
    at = group_starts(b)
    return list(zip(b[at].tolist(), at.tolist(), [*at[1:].tolist(), len(b)], strict=True)) if len(b) else []


def pack_sorted(values: np.ndarray) -> bytes:
    """Sorted 64-bit values as byte planes of their differences: the high planes compress away."""
    deltas = np.diff(values, prepend=np.uint64(0))
    return deltas.view(np.uint8).reshape(-1, 8).T.tobytes()


def unpack_sorted(blob: bytes, n: int) -> np.ndarray:
    planes = np.frombuffer(blob, np.uint8, 8 * n).reshape(8, n)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint64).reshape(-1), dtype=np.uint64)


def squeeze(blob: bytes) -> bytes:
    """A blob in less room: planes of hashes and counts have few bits to a byte."""
    return len(blob).to_bytes(8, "little") + _CODEC.compress(blob, asbytes=True)


def swell(blob: bytes) -> bytes:
    return _CODEC.decompress(memoryview(blob)[8:], int.from_bytes(blob[:8], "little"), asbytes=True)


def letters(rows: list[tuple[int, int, bytes]]) -> pa.Table:
    b, c, x = zip(*((b, c, squeeze(x)) for b, c, x in rows), strict=True) if rows else ((), (), ())
    return pa.table({"bucket": pa.array(b, pa.int32()), "chunk": pa.array(c, pa.int32()), "blob": pa.array(x, pa.binary())})


def send(chunks: DataFrame, ask: Callable[[pa.Table], list[tuple[int, int, bytes]]]) -> DataFrame:
    """First questions, made from the documents of a chunk alone."""

    def group(t: pa.Table) -> pa.Table:
        try:
            return in_slices(letters(ask(t)))
        finally:
            trim()

    return chunks.groupBy("chunk").applyInArrow(group, LETTER)


def answer(questions: DataFrame, reply: Callable[[list[bytes]], list[bytes]]) -> DataFrame:
    """Each bucket's answers, one to each question blob."""

    def group(t: pa.Table) -> pa.Table:
        try:
            found = reply([swell(b) for b in t.column("blob").to_pylist()])
            return in_slices(letters(list(zip(t.column("bucket").to_pylist(), t.column("chunk").to_pylist(), found, strict=True))))
        finally:
            trim()

    return questions.groupBy("bucket").applyInArrow(group, LETTER)


def _mail(t: pa.Table) -> dict[int, bytes]:
    return dict(zip(t.column("bucket").to_pylist(), map(swell, t.column("blob").to_pylist()), strict=True))


def meet(chunks: DataFrame, answers: DataFrame, then: Callable[[pa.Table, dict[int, bytes]], pa.Table], schema: str) -> DataFrame:
    """Hand each chunk its documents and the answers of the buckets it asked."""

    def group(docs: pa.Table, mail: pa.Table) -> pa.Table:
        try:
            return in_slices(then(docs, _mail(mail)))
        finally:
            trim()

    return chunks.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(group, schema)


def ask_census(values: np.ndarray, many: np.ndarray, counts: np.ndarray, chunk: int, buckets: int) -> list[tuple[int, int, bytes]]:
    """Ask of each of the chunk's sorted ``values`` whether other chunks have it, or one with ``many``, and whether it is hot.

    ``counts`` says how often the value counts in this chunk.  Counts travel whole,
    as four planes of bytes: nearly all are 1, so that the planes compress away.
    """

    def planes(c: np.ndarray) -> bytes:
        return np.minimum(c, (1 << 32) - 1).astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()

    return [(b, chunk, np.int64(hi - lo).tobytes() + np.packbits(many[lo:hi]).tobytes() + planes(counts[lo:hi]) + pack_sorted(values[lo:hi])) for b, lo, hi in runs_by_bucket(values, buckets)]


def census(blobs: list[bytes], hot: int) -> list[bytes]:
    """For each value of each blob two bits: it was marked or came in another blob too; its counts sum to more than ``hot``."""
    values, marks, counts, sizes = [], [], [], []
    for b in blobs:
        n = int(np.frombuffer(b, np.int64, 1)[0])
        m = -(-n // 8)
        marks.append(np.unpackbits(np.frombuffer(b, np.uint8, m, 8), count=n).astype(bool))
        planes = np.frombuffer(b, np.uint8, 4 * n, 8 + m).reshape(4, n)
        counts.append(np.ascontiguousarray(planes.T).view("<u4").reshape(-1).astype(np.int64))
        values.append(unpack_sorted(b[8 + m + 4 * n :], n))
        sizes.append(n)
    v, m, c = np.concatenate(values), np.concatenate(marks), np.concatenate(counts)
    order = np.argsort(v, kind="stable")
    starts = group_starts(v[order])
    width = np.diff(np.append(starts, len(v)))
    twice, many = np.zeros(len(v), bool), np.zeros(len(v), bool)
    twice[order] = np.repeat((width > 1) | (np.add.reduceat(m[order].astype(np.int64), starts) > 0), width)
    many[order] = np.repeat(np.add.reduceat(c[order], starts) > hot, width)
    cuts = np.cumsum(sizes)[:-1]
    return [np.packbits(a).tobytes() + np.packbits(b).tobytes() for a, b in zip(np.split(twice, cuts), np.split(many, cuts), strict=True)]


def read_census(values: np.ndarray, mail: dict[int, bytes], buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The two answers of ``census``, in the order of the sorted ``values`` asked for."""
    twice, hot = np.zeros(len(values), bool), np.zeros(len(values), bool)
    for b, lo, hi in runs_by_bucket(values, buckets):
        bits = np.frombuffer(mail[b], np.uint8).reshape(2, -1)
        twice[lo:hi], hot[lo:hi] = (np.unpackbits(x, count=hi - lo) for x in bits)
    return twice, hot


def two_rounds(mail: dict[int, bytes]) -> tuple[dict[int, bytes], dict[int, bytes]]:
    """Mail that ``both`` has united, by round."""
    return {b >> 1: m for b, m in mail.items() if not b & 1}, {b >> 1: m for b, m in mail.items() if b & 1}


def both(first: DataFrame, second: DataFrame) -> DataFrame:
    """The answers of two rounds in one table."""
    return first.selectExpr("bucket * 2 as bucket", "chunk", "blob").union(second.selectExpr("bucket * 2 + 1 as bucket", "chunk", "blob"))
