"""Connected components, and the edges on directed cycles, by labels that spread and jump: DataFrame joins alone."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from heirloom.cut import ROWS_EACH, cut, gathered


def _contracted(a: pa.Array, b: pa.Array) -> tuple[pa.Array, pa.Array]:
    """The vertices of some edges, and the smallest vertex that each reaches over these edges alone."""
    every = pa.concat_arrays([a, b])
    ids = every.unique()
    ids = ids.take(pc.sort_indices(ids))
    x, y = np.split(pc.index_in(every, ids).to_numpy(), 2)
    root, was = np.arange(len(ids)), None
    while was is None or (root != was).any():
        was = root
        low = np.minimum(root[x], root[y])
        root = root.copy()
        np.minimum.at(root, was[x], low)
        np.minimum.at(root, was[y], low)
        while (root[root] != root).any():
            root = root[root]
    return ids, ids.take(pa.array(root))


def contract(edges: DataFrame, each: int) -> DataFrame:
    """``a, b``, of one type, with every run of at most ``each`` edges of a partition replaced by edges from its vertices to the smallest that they reach in it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            for at in range(0, batch.num_rows, each):
                part = batch.slice(at, each)
                if held and n + part.num_rows > each:
                    yield from told(held)
                    held, n = [], 0
                held.append(part)
                n += part.num_rows
        if held:
            yield from told(held)

    def told(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = pa.Table.from_batches(held).combine_chunks()
        yield pa.RecordBatch.from_arrays(list(_contracted(*[c.combine_chunks() for c in t.columns])), ["a", "b"])

    kind = edges.schema["a"].dataType
    return edges.mapInArrow(run, T.StructType([T.StructField(c, kind) for c in ("a", "b")]))


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst", max_rounds: int = 60) -> DataFrame:
    """Label every vertex of ``edges`` with the smallest vertex that it reaches.

    Returns ``(id, component)``, one row per vertex that has an edge to another
    vertex or to itself.  Edges with a null end are ignored.  Every round sends
    the smallest known label over each edge and then follows the label of the
    label (pointer jumping), so that long chains take a logarithmic number of
    rounds.  A vertex of high degree costs one partially aggregated group.
    Before, every task joins up what its own edges connect, ``ROWS_EACH`` at a time;
    where there are no more edges than that in all, it needs no round.
    Raises ``RuntimeError`` if labels still change after ``max_rounds``.
    """
    e = edges.select(F.col(src).alias("a"), F.col(dst).alias("b")).where("a is not null and b is not null")
    if len({f.dataType for f in e.schema}) > 1:
        wide = e.select(F.col("a").alias("id")).union(e.select("b")).schema["id"].dataType
        e = e.select(F.col("a").cast(wide).alias("a"), F.col("b").cast(wide).alias("b"))
    e, n = gathered(e.distinct(), ROWS_EACH)
    e = contract(e, ROWS_EACH)
    if n <= ROWS_EACH:
        return cut(e.toDF("id", "component"))
    both = cut(e.union(e.select(F.col("b"), F.col("a"))).distinct())
    labels = cut(both.groupBy(F.col("a").alias("id")).agg(F.min(F.least("a", "b")).alias("component")))
    for _ in range(max_rounds):
        near = (
            both.join(labels, both.b == labels.id)
            .groupBy(F.col("a").alias("id"))
            .agg(F.min("component").alias("near"))
        )
        lowered = labels.join(near, "id").select(
            "id", F.col("component").alias("was"), F.least("component", "near").alias("component")
        )
        hop = lowered.select(F.col("id").alias("hop"), F.col("component").alias("hop_label"))
        stepped = cut(
            lowered.join(hop, lowered.component == hop.hop, "left").select(
                "id", "was", F.least("component", F.coalesce("hop_label", "component")).alias("component")
            )
        )
        moved = stepped.where("component <> was").limit(1).count()
        labels = stepped.select("id", "component")
        if not moved:
            return labels
    raise RuntimeError(f"components did not settle within {max_rounds} rounds")


def without_tails(edges: DataFrame, max_rounds: int = 64) -> DataFrame:
    """``a, b`` without vertices that a single path leads to from a beginning, or from which a single path leads to an end.

    A vertex with one edge in points at the vertex that it comes from, and one with one edge out at the next;
    the pointers double in every round, so that a chain of any length is gone in as many rounds as its length has
    binary digits.  Pointers that go round never settle: after that many rounds they are left alone.
    """
    into = edges.groupBy(F.col("b").alias("id")).agg(F.count(F.lit(1)).alias("n_in"), F.min("a").alias("prev"))
    out = edges.groupBy(F.col("a").alias("id")).agg(F.count(F.lit(1)).alias("n_out"), F.min("b").alias("next"))
    state = into.join(out, "id", "full")
    up, down = (F.when(F.col(n) == 1, F.col(x)).otherwise(F.col("id")) for n, x in (("n_in", "prev"), ("n_out", "next")))
    state = cut(state.select("id", up.alias("up"), down.alias("down"), F.col("n_in").isNull().alias("begins"), F.col("n_out").isNull().alias("stops")))
    ends = state.select("id", "begins", "stops")
    for _ in range(min(max_rounds, state.count().bit_length())):
        far = state.select(F.col("id").alias("_id"), F.col("up").alias("_up"), F.col("down").alias("_down"))
        there = state.select("id", "up", "down").join(far.select(F.col("_id").alias("up"), "_up"), "up").join(far.select(F.col("_id").alias("down"), "_down"), "down")
        doubled = cut(there.select("id", F.col("_up").alias("up"), F.col("_down").alias("down"), ((F.col("_up") != F.col("up")) | (F.col("_down") != F.col("down"))).alias("settling")))
        state = doubled.select("id", "up", "down")
        if not doubled.where("settling").limit(1).count():
            break
    gone = state.select("id", "up", "down").join(ends.select(F.col("id").alias("up"), "begins"), "up").join(ends.select(F.col("id").alias("down"), "stops"), "down").where("begins or stops").select("id")
    return edges.join(gone.toDF("a"), "a", "left_anti").join(gone.toDF("b"), "b", "left_anti").select("a", "b")


def cycle_edges(edges: DataFrame, src: str = "src", dst: str = "tgt", orders: int = 6, max_rounds: int = 400) -> DataFrame:
    """The distinct edges whose ends lie in one strongly connected component: those on a directed cycle, and loops.

    Vertices get ``orders`` random ranks.  For each rank a vertex learns the lowest vertex that reaches it
    (forward) and the lowest that it reaches (backward).  All vertices of a component learn the same, so

    * a vertex whose two lowest vertices of the first rank are one and the same lies in that
      vertex's component, and edges between vertices of one such component are found;
    * an edge between vertices that differ in any label lies on no cycle and goes.

    What is left starts again with new ranks; each time the lowest vertex of what hangs together is settled.
    Labels take a step along the edges and those of the lowest vertex known so far (pointer jumping, by each rank in turn), so
    that they cross long chains in a logarithmic number of rounds; several ranks cut chains into many pieces at once.
    Trees and chains that hang on the rest are taken off first (``without_tails``).
    A round reads each edge twice and keeps a row a vertex: no pairs of vertices that are not edges are made.
    Edges with a null end are left out.  Raises ``RuntimeError`` after ``max_rounds`` rounds.
    """
    given = edges.select(F.col(src).alias("a"), F.col(dst).alias("b")).where("a is not null and b is not null").distinct()
    e = cut(given)
    found = [e.where("a = b")]
    e = cut(without_tails(e.where("a <> b")))
    kinds = [f"{d}{i}" for d in "fb" for i in range(orders)]
    lowest = {c: F.least(*[F.coalesce(x, F.col(c)) for x in (F.col(f"near_{c}"), F.col(f"far_{c}"), F.col(c))]) for c in kinds}
    rounds = seed = 0
    while True:
        # Beginnings and ends lie on no cycle.
        e = cut(e.join(e.select(F.col("b").alias("a")).distinct(), "a", "left_semi").join(e.select(F.col("a").alias("b")).distinct(), "b", "left_semi").select("a", "b"))
        if not e.limit(1).count():
            break
        rank = [F.struct(F.xxhash64("id", F.lit(seed + i)).alias("rank"), F.col("id").alias("of")) for i in range(orders)]
        seed += orders
        state = cut(e.select(F.col("a").alias("id")).union(e.select("b")).distinct().select("id", *[r.alias(f"{d}{i}") for d in "fb" for i, r in enumerate(rank)]))
        while True:
            rounds += 1
            if rounds > max_rounds:
                raise RuntimeError(f"cycles were not found within {max_rounds} rounds")
            near, by = state, rounds % orders
            for d, at, to in (("f", "a", "b"), ("b", "b", "a")):
                mine = [c for c in kinds if c[0] == d]
                step = e.join(state.select(F.col("id").alias(at), *mine), at).groupBy(F.col(to).alias("id")).agg(*[F.min(c).alias(f"near_{c}") for c in mine])
                jump = state.select(F.col("id").alias(f"_{d}"), *[F.col(c).alias(f"far_{c}") for c in mine])
                near = near.join(step, "id", "left").withColumn(f"_{d}", F.col(f"{d}{by}.of")).join(jump, f"_{d}", "left")
            moved = F.lit(False)
            for c in kinds:
                moved = moved | (lowest[c] != F.col(c))
            stepped = cut(near.select("id", *[lowest[c].alias(c) for c in kinds], moved.alias("moved")))
            state = stepped.drop("moved")
            if not stepped.where("moved").limit(1).count():
                break
        label = F.when(F.col("f0.of") == F.col("b0.of"), F.col("f0.of")).alias("root")
        known = state.select("id", F.xxhash64(*[F.col(f"{c}.rank") for c in kinds]).alias("all"), label)
        ends = e.join(known.toDF("a", "all_a", "root_a"), "a").join(known.toDF("b", "all_b", "root_b"), "b")
        settled = ends.where("all_a = all_b")
        settled = cut(settled.select("a", "b", F.coalesce(F.col("root_a") == F.col("root_b"), F.lit(False)).alias("found")))
        found.append(settled.where("found").select("a", "b"))
        e = settled.where("not found").select("a", "b")
    return reduce(DataFrame.union, found).select(F.col("a").alias(src), F.col("b").alias(dst))
