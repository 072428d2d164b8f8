"""Vector codes: each part of a vector becomes the number of its nearest codebook entry.

Distances are not computed to all entries.  An entry is first compared by the
means of a few blocks of components and by the norms of what the means leave:
by Cauchy and Schwarz

    |x - c|^2  >=  sum over blocks of len * (mean x - mean c)^2  +  (|rest of x| - |rest of c|)^2

Blocks get finer from level to level.  An entry leaves as soon as its bound is
above the distance to the entry that looked best at first; what remains gets its exact
integer distance.  Bounds are lowered by far more than floats can err, so that no
nearest entry, and no tie, is lost.

The codebooks (parts x entries x components, a fixed number) go to every task
with its closure; tasks return one row of sums for each component of each entry.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from heirloom.llm.vectors import digest, floor_means, kept_vectors, scaled, slices

#: Share of the squared norms that bounds are lowered by; doubles err by about 1e-15 of these.
SLACK = 1e-9
_ROWS = 4096


class Bounds:
    """Block sums and residual norms of vectors at every level, from one block to blocks of two."""

    def __init__(self, x: np.ndarray):
        self.width = x.shape[1]
        self.norms = (x * x).sum(1)
        self.levels = []
        blocks = 1
        while blocks <= max(1, self.width // 2):
            edges = np.linspace(0, self.width, blocks + 1).astype(np.int64)
            length = np.diff(edges)
            means = np.add.reduceat(x, edges[:-1], axis=1) / length
            rest = x - np.repeat(means, length, axis=1)
            # Means times the root of the length: squared differences of these are len * (difference of means)^2.
            self.levels.append((means * np.sqrt(length), np.sqrt((rest * rest).sum(1))))
            blocks *= 2


def nearest(x: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each row of ``x`` its nearest row of ``book`` (ties: the first), the squared distance, and how many exact distances were taken."""
    n, k = len(x), len(book)
    if not n:
        return (np.zeros(0, np.int64),) * 3
    mine, theirs = Bounds(x), Bounds(book)
    slack = SLACK * (mine.norms[:, None] + theirs.norms[None, :]) + SLACK
    best = reach = row = entry = None
    for (xm, xr), (bm, br) in zip(mine.levels, theirs.levels, strict=True):
        if best is None:
            bound = ((xm[:, None, :] - bm[None, :, :]) ** 2).sum(2) + (xr[:, None] - br[None, :]) ** 2
            best = bound.argmin(1)
            gap = x - book[best]
            reach = (gap * gap).sum(1)
            row, entry = np.nonzero(bound - slack <= reach[:, None])
        else:
            gap = xm[row] - bm[entry]
            bound = (gap * gap).sum(1) + (xr[row] - br[entry]) ** 2
            live = bound - slack[row, entry] <= reach[row]
            row, entry = row[live], entry[live]
    gap = x[row] - book[entry]
    exact = (gap * gap).sum(1)
    # Rows are in order, and entries within a row: the first of the smallest wins.
    starts = np.searchsorted(row, np.arange(n))
    least = np.minimum.reduceat(exact, starts)
    taken = np.diff(np.append(starts, len(row)))
    at = np.where(exact == np.repeat(least, taken), entry, k)
    return np.minimum.reduceat(at, starts), least, taken


def _matrices(batches: Iterator[pa.RecordBatch], width: int, scale: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for b in slices(batch, _ROWS):
            yield b, scaled(b.column("v"), width, scale)


def _sums(kept: DataFrame, books: list[np.ndarray], scale: int) -> DataFrame:
    """``part, entry, place, total``: sums of the parts' components by nearest entry; at place -1 their number."""
    step = books[0].shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(books), len(books[0]), step + 1), np.int64)
        for _, x in _matrices(batches, step * len(books), scale):
            for p, book in enumerate(books):
                part = x[:, p * step : (p + 1) * step]
                near = nearest(part, book)[0]
                np.add.at(total[p], near, np.column_stack([np.ones(len(part), np.int64), part]))
        part, entry, place = (a.reshape(-1) for a in np.indices(total.shape))
        yield pa.RecordBatch.from_arrays([pa.array(a) for a in (part, entry, place - 1, total.reshape(-1))], ["part", "entry", "place", "total"])

    found = kept.select("v").mapInArrow(run, "part long, entry long, place long, total long")
    return found.groupBy("part", "entry", "place").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))


def first_entries(kept: DataFrame, parts: int, entries: int, scale: int) -> list[np.ndarray]:
    """The parts of the ``entries`` smallest ids, by part; ids that are equal go by their vectors, null ids last."""
    rows = kept.orderBy(F.col("id").asc_nulls_last(), "v").limit(entries).select("v").collect()
    x = np.array([scaled(pa.array([r.v]), len(r.v), scale)[0] for r in rows])
    return np.split(x, parts, axis=1)


def train(kept: DataFrame, parts: int, entries: int, rounds: int, scale: int) -> list[np.ndarray]:
    """Codebooks after ``rounds`` rounds of assignment and rounded-down means."""
    books = first_entries(kept, parts, entries, scale)
    for _ in range(rounds):
        rows = _sums(kept, books, scale).collect()  # parts x entries x components rows, whatever the input
        for p, book in enumerate(books):
            mine = [r for r in rows if r.part == p]
            counts = {r.entry: int(r.total) for r in mine if r.place == -1 and r.total}
            books[p] = floor_means({(r.entry, r.place): int(r.total) for r in mine}, counts, book)
    return books


def compress(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096) -> tuple[DataFrame, list[np.ndarray]]:
    """Vectors as codes, and the codebooks.

    Every component ``x`` becomes ``floor(scale * x)``, and the vector is cut into
    ``parts`` equal consecutive parts.  A part's codebook starts as that part of the vectors with the
    ``entries`` (at most 256) smallest keys and is trained for ``rounds`` rounds: parts go to the
    nearest entry (ties: the lower), entries to the rounded-down mean of their parts.

    Returns ``rows`` without those whose vector is null, empty or holds null or
    non-finite components, with ``code`` (two hexadecimal digits a part),
    ``error`` (squared distances summed) and ``n_exact`` (how many exact distances the bounds left).
    All vectors must have one length, a multiple of ``parts``: those with another length than the one with the smallest
    key among the multiples are left out.  Scaled components beyond 2**27 count as that bound.  With fewer vectors than
    ``entries`` the codebooks are that short; entries without parts stay.  Repeated rows count and come back each; null
    keys come last.  Input columns named ``code``, ``error`` or ``n_exact`` are replaced, others pass through.  An empty input gives
    an empty result and no codebooks.
    """
    if not 0 < entries <= 256:
        raise ValueError("codes have two hexadecimal digits")
    kept = kept_vectors(rows, vector, id=key).where(F.size("v") % parts == 0)
    one = kept.orderBy(F.col("id").asc_nulls_last(), "v").limit(1).collect()
    width = len(one[0].v) if one else parts
    kept = kept.where(F.size("v") == width)
    books = train(kept, parts, entries, rounds, scale) if one else []
    new = {"code": T.StringType(), "error": T.LongType(), "n_exact": T.LongType()}
    passed = [c for c in rows.columns if c.lower() not in new]
    # Arrow functions do not take every name that a column can have.
    d = kept_vectors(rows, vector, **{f"c{i}": c for i, c in enumerate(passed)}).where(F.size("v") == width)
    schema = T.StructType([*d.drop("v").schema.fields, *[T.StructField(n, kind) for n, kind in new.items()]])
    step = width // parts

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, x in _matrices(batches, width, scale):
            found = [nearest(x[:, p * step : (p + 1) * step], book) for p, book in enumerate(books)]
            if found:
                code = np.column_stack([f[0] for f in found]).astype(np.uint8)
                text = [c.tobytes().hex() for c in code]
                error, exact = (sum(f[i] for f in found) for i in (1, 2))
                yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(text), pa.array(error), pa.array(exact)], schema.names)

    return d.mapInArrow(run, schema).toDF(*passed, *new), books


def books_sha256(books: list[np.ndarray]) -> str:
    """A digest of all entries' components, by part, entry and place."""
    return digest(x for book in books for x in book.reshape(-1))
