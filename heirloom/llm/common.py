"""Small helpers that the corpus operators share."""

from __future__ import annotations

import contextlib
import ctypes
import re
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: The whitespace that separates words everywhere in this subpackage.
WORD = r"[^\x20\x09-\x0D]+"


#: Rows of an Arrow batch at most.  Texts are long, and both the executor and its worker hold a batch.
BATCH_ROWS = 2000
#: Bytes of an Arrow batch at which it ends, where steps follow each other on the same executors: buffers of several MB
#: lie outside the heap, and what is freed of them stays with the executor.
BATCH_BYTES = 1 << 19


def bound_batches(spark: SparkSession, n_bytes: int | None = None) -> None:
    """Keep the session's Arrow batches to ``BATCH_ROWS`` rows and, if given, about ``n_bytes``, or fewer where it says so."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if n_bytes and not 0 < _in_bytes(spark.conf.get(key)) <= n_bytes:
        spark.conf.set(key, str(n_bytes))


def _in_bytes(said: str) -> int:
    """A size as Spark's settings say it: ``1m``, ``64kb``, ``1048576``."""
    number, unit = re.fullmatch(r"(-?\d+)\s*([kmgtp]?)b?", said.strip().lower()).groups()
    return int(number) << 10 * " kmgtp".index(unit or " ")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    bound_batches(spark)
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def column(name: str) -> Column:
    """A column by its plain name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def spare(columns: list[str], *names: str) -> list[str]:
    """``names``, each with underscores before it until no column has it."""
    taken, out = {c.lower() for c in columns}, []
    for n in names:
        while n.lower() in taken:
            n = "_" + n
        out.append(n)
    return out


def as_bytes(column: pa.ChunkedArray | pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column; null counts as empty."""
    return [b"" if x is None else x for x in column.cast(pa.binary()).to_pylist()]


def batches_of(blobs: list[bytes], limit: int) -> Iterator[tuple[int, int]]:
    """Index ranges of ``blobs`` that hold at most ``limit`` bytes, or one blob."""
    at, held = 0, 0
    for i, b in enumerate(blobs):
        if held and held + len(b) > limit:
            yield at, i
            at, held = i, 0
        held += len(b)
    if at < len(blobs):
        yield at, len(blobs)


def small_batches(batches: Iterable[pa.RecordBatch], column: str, limit: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of Arrow batches whose ``column`` holds about ``limit`` bytes at most."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = [0 if x is None else x for x in pa.compute.binary_length(batch.column(column)).to_pylist()]
        at, held = 0, 0
        for i, n in enumerate(sizes):
            if held and held + n > limit:
                yield batch.slice(at, i - at)
                at, held = i, 0
            held += n
        yield batch.slice(at)


def in_slices(t: pa.Table, limit: int = BATCH_BYTES) -> pa.Table:
    """``t`` in batches of about ``limit`` bytes, or one row: a group's result crosses to the executor batch by batch."""
    each = max(1, t.num_rows * limit // max(1, t.nbytes))
    return t if each >= t.num_rows else pa.Table.from_batches(t.to_batches(max_chunksize=each), t.schema)


def total_bytes(docs: DataFrame, text: str = "text") -> int:
    """Bytes of all texts: one aggregated row."""
    return docs.agg(F.sum(F.octet_length(text))).first()[0] or 0


def parts_for(n_bytes: int, each: int) -> int:
    return max(1, -(-n_bytes // each))


def trim() -> None:
    """Give freed memory back: workers live on between tasks, and an executor's share is fixed."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def trimmed(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run`` over a partition's batches, giving memory back at its end."""

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            trim()

    return over


MapArrow = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def add_columns(docs: DataFrame, text: str, new: dict[str, T.DataType], compute: Callable[[pa.Array], list[pa.Array]]) -> DataFrame:
    """``docs`` and the columns ``new``, computed from batches of ``text``; input columns of these names are replaced."""
    gone = {n.lower() for n in new}
    passed = [c for c in docs.columns if c.lower() not in gone]
    if text not in passed:
        raise ValueError(f"{text!r} would be replaced")
    # Working names: Arrow functions do not take every name that a column can have.
    d = docs.select(*[column(c).alias(f"c{i}") for i, c in enumerate(passed)])
    body = f"c{passed.index(text)}"
    names = [f"n{i}" for i in range(len(new))]
    schema = T.StructType([*d.schema.fields, *[T.StructField(n, kind) for n, kind in zip(names, new.values(), strict=True)]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, body):
            yield pa.RecordBatch.from_arrays([*batch.columns, *compute(batch.column(body))], schema.names)

    return d.mapInArrow(trimmed(run), schema).toDF(*passed, *new)
