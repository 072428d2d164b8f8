"""Integer vectors: what code compression and clustering of embeddings share."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from heirloom.llm.common import column, spare

#: Scaled components lie within this bound, and count as the bound beyond it: squared distances must fit a long.
LARGEST = 1 << 27
#: A value is frequent if one in so many rows has it; there are at most so many such values.
HOT_SHARE = 1024


def usable(vector: Column) -> Column:
    """Neither null nor empty, and no component that is null or not finite."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return vector.isNotNull() & (F.size(vector) > 0) & ~F.exists(vector, bad)


def kept_vectors(rows: DataFrame, vector: str, **names: str) -> DataFrame:
    """``v`` (doubles) and the columns ``names`` (new name = old name) of the rows whose vector is usable."""
    v = column(vector).cast("array<double>")
    return rows.select(*[column(old).alias(new) for new, old in names.items()], v.alias("v")).where(usable(F.col("v")))


def scaled(v: pa.Array, width: int, scale: int) -> np.ndarray:
    """``floor(scale * x)`` of vectors of one width, as a matrix of 64-bit integers."""
    flat = v.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return np.clip(np.floor(flat * scale), -LARGEST, LARGEST).astype(np.int64).reshape(-1, width)


def slices(batch: pa.RecordBatch, rows: int) -> Iterator[pa.RecordBatch]:
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def floor_means(sums: dict[tuple, int], counts: dict[tuple, int], old: np.ndarray) -> np.ndarray:
    """``old`` with each row ``i`` that has a count replaced by its sums ``(i, position)`` over that count, rounded down."""
    new = old.copy()
    for i, n in counts.items():
        for j in range(old.shape[1]):
            new[i, j] = sums[i, j] // n
    return new


def digest(numbers: Iterable[int]) -> str:
    return hashlib.sha256(",".join(str(int(x)) for x in numbers).encode()).hexdigest()


def with_group_sum(rows: DataFrame, group: str, value: str, name: str) -> DataFrame:
    """Add ``name``, the sum of ``value`` over the rows with an equal ``group``, nulls together.

    Sums are made with partial aggregation.  The few groups that hold one row in
    ``HOT_SHARE`` or more are handed out by broadcast (at most ``HOT_SHARE`` rows);
    all others are small, and meet their rows in a join by group.
    """
    key, n, hot_sum, cold_sum = spare(rows.columns, "_key", "_n", "_hot_sum", "_cold_sum")
    # A key that no value shares with null.
    d = rows.withColumn(key, F.coalesce(F.concat(F.lit("v"), column(group).cast("string")), F.lit("null")))
    sums = d.groupBy(key).agg(F.sum(column(value)).alias(name), F.count(F.lit(1)).alias(n))
    floor = max(1, rows.count() // HOT_SHARE)
    hot = F.broadcast(sums.where(F.col(n) >= floor).select(key, F.col(name).alias(hot_sum)))
    cold = sums.where(F.col(n) < floor).select(key, F.col(name).alias(cold_sum))
    met = d.join(hot, key, "left")
    some = met.where(F.col(hot_sum).isNotNull()).withColumn(cold_sum, F.lit(None).cast("long"))
    rest = met.where(F.col(hot_sum).isNull()).join(cold, key, "left")
    both = some.unionByName(rest)
    return both.select(*map(column, rows.columns), F.coalesce(hot_sum, cold_sum).alias(name))
