"""Centroid clustering by plain Lloyd rounds on integer vectors.

The centroids, a fixed number of rows, are broadcast each round.  Every task
takes the integer squared difference of its vectors to each centroid in turn,
and returns one row of integer sums a cluster; these rows are merged by a
grouped sum, so that a cluster that holds most vectors costs no more than others.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from heirloom.llm.vectors import digest, floor_means, kept_vectors, scaled


def assign(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centroid of each row (ties: the lowest number), and the squared distance."""
    d = np.empty((len(x), len(centroids)), np.int64)
    for i, c in enumerate(centroids):
        gap = x - c
        d[:, i] = (gap * gap).sum(1)
    near = d.argmin(1)
    return near, d[np.arange(len(x)), near]


def matrix(v: pd.Series, width: int, scale: int) -> np.ndarray:
    return scaled(pa.array(v, pa.list_(pa.float64())), width, scale)


def _kept(rows: DataFrame, vector: str, width: int, **names: str) -> DataFrame:
    return kept_vectors(rows, vector, **names).where(F.size("v") == width)


def first_centroids(rows: DataFrame, key: str, vector: str, clusters: int, width: int, scale: int, seed: int) -> np.ndarray:
    """The vectors with the smallest digests of ``seed:key``; equal keys go by their vectors."""
    named = F.coalesce(F.col("id").cast("string"), F.lit("null"))
    order = F.sha2(F.concat(F.lit(f"{seed}:"), named), 256)
    found = _kept(rows, vector, width, id=key).orderBy(order, "v").limit(clusters).select("v").collect()
    return np.array([scaled(pa.array([r.v]), width, scale)[0] for r in found], np.int64).reshape(-1, width)


def next_centroids(rows: DataFrame, vector: str, centroids: np.ndarray, scale: int) -> np.ndarray:
    """One round: vectors to their nearest centroid, centroids to the rounded-down mean of their vectors."""
    k, width = centroids.shape
    shared = rows.sparkSession.sparkContext.broadcast(centroids)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, count = np.zeros((k, width), np.int64), np.zeros(k, np.int64)
        for f in frames:
            x = matrix(f["v"], width, scale)
            near = assign(x, shared.value)[0]
            np.add.at(total, near, x)
            count += np.bincount(near, minlength=k)
        yield pd.DataFrame({"cluster": np.arange(k), "n": count, "total": list(total)})

    sums = _kept(rows, vector, width).mapInPandas(run, "cluster long, n long, total array<long>")
    # One grouped sum a component: the row of a cluster is as wide as a centroid.
    each = [F.sum(F.get("total", F.lit(j)).cast("decimal(38,0)")).alias(f"t{j}") for j in range(width)]
    found = sums.groupBy("cluster").agg(F.sum("n").alias("n"), F.array(*each).alias("total")).where("n > 0").collect()
    shared.unpersist()
    totals = {(r.cluster, j): int(t) for r in found for j, t in enumerate(r.total)}
    return floor_means(totals, {r.cluster: r.n for r in found}, centroids)


def train(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", clusters: int = 8, width: int = 64, rounds: int = 10, scale: int = 1024, seed: int = 3) -> np.ndarray:
    """Centroids after ``rounds`` rounds; those without vectors stay where they are."""
    centroids = first_centroids(rows, key, vector, clusters, width, scale, seed)
    for _ in range(rounds if len(centroids) else 0):
        centroids = next_centroids(rows, vector, centroids, scale)
    return centroids


def with_nearest(rows: DataFrame, centroids: np.ndarray, vector: str = "embedding", scale: int = 1024) -> DataFrame:
    """The rows with usable vectors, with ``cluster`` and ``distance`` (squared) of the nearest centroid.

    Rows are left out whose vector is null, is not as long as a centroid, or holds
    null or non-finite components; without centroids none is left.  Scaled components beyond 2**27
    count as that bound.  Input columns of these two names are replaced.
    """
    new = {"cluster": T.IntegerType(), "distance": T.LongType()}
    passed = [c for c in rows.columns if c.lower() not in new]
    width = centroids.shape[1]
    d = _kept(rows, vector, width, **{f"c{i}": c for i, c in enumerate(passed)})
    schema = T.StructType([*d.drop("v").schema.fields, *[T.StructField(n, kind) for n, kind in new.items()]])
    shared: Broadcast = rows.sparkSession.sparkContext.broadcast(centroids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows and len(shared.value):
                near, distance = assign(scaled(b.column("v"), width, scale), shared.value)
                yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(near, pa.int32()), pa.array(distance)], schema.names)

    return d.mapInArrow(run, schema).toDF(*passed, *new)


def centroid_digests(spark: SparkSession, centroids: np.ndarray) -> DataFrame:
    """``cluster, centroid_sha256``: one row a centroid."""
    return spark.createDataFrame([(i, digest(c)) for i, c in enumerate(centroids)], "cluster int, centroid_sha256 string")


def cluster(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", clusters: int = 8, width: int = 64, rounds: int = 10, scale: int = 1024, seed: int = 3) -> tuple[DataFrame, np.ndarray]:
    """Vectors with ``cluster`` and ``distance``, and the final centroids.

    Components count as ``floor(scale * x)``.  Centroids start as the vectors with
    the smallest digests of ``seed:key`` (a null key reads ``null``), fewer where there are fewer
    vectors; after ``rounds`` rounds vectors are assigned once more.  Repeated rows count and come back
    each.  Which rows are left out, and column names: see ``with_nearest``.  An empty input gives an empty result.
    """
    centroids = train(rows, key, vector, clusters, width, rounds, scale, seed)
    return with_nearest(rows, centroids, vector, scale), centroids
