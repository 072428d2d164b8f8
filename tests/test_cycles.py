"""Edges on directed cycles against strongly connected components found one vertex at a time."""

import random

import pytest

from heirloom.operators import components


def plain(edges):
    """Edges whose ends reach each other."""
    out = {}
    for a, b in edges:
        out.setdefault(a, set()).add(b)

    def reach(v):
        seen, todo = set(), [v]
        while todo:
            for w in out.get(todo.pop(), ()):
                if w not in seen:
                    seen.add(w)
                    todo.append(w)
        return seen

    reaches = {v: reach(v) for e in edges for v in e}
    return sorted({(a, b) for a, b in edges if a in reaches[b]})


@pytest.fixture
def rounds(monkeypatch):
    """How many rounds of labels and pointers were taken, by the checkpoints of states."""
    made = []
    real = components.cut
    monkeypatch.setattr(components, "cut", lambda df: (made.append("moved" in df.columns or "settling" in df.columns), real(df))[1])
    return lambda: sum(made)


def found(spark, edges, **more):
    d = spark.createDataFrame(edges, "src long, tgt long").repartition(4)
    return sorted((r.src, r.tgt) for r in components.cycle_edges(d, **more).collect())


def test_random_graphs(spark):
    r = random.Random(3)
    for n, m in ((12, 14), (60, 70)):
        edges = [(r.randrange(n), r.randrange(n)) for _ in range(m)]
        assert found(spark, edges + edges[:3], orders=2) == plain(edges)


def test_odd_edges(spark):
    assert found(spark, [(None, 1), (1, None), (2, 2), (3, 4), (4, 3), (4, 5)]) == [(2, 2), (3, 4), (4, 3)]
    assert components.cycle_edges(spark.createDataFrame([], "src string, tgt string")).collect() == []


def test_ring_of_ten_thousand(spark, rounds):
    n = 10_000
    ring = [((i + 1) % n, i) for i in range(n)]
    assert len(found(spark, ring + [(i, n + i) for i in range(50)])) == n
    assert rounds() <= 60


def test_long_chain(spark, rounds):
    assert found(spark, [(i, i + 1) for i in range(100_000)]) == []
    assert rounds() <= 20


def test_layers_without_cycles(spark, rounds):
    """Neither chains nor trees: every vertex has two edges in and two out."""
    n, wide = 60, 4
    edges = [(wide * i + j, wide * (i + 1) + (j + k) % wide) for i in range(n) for j in range(wide) for k in (0, 1)]
    back = [(wide * 40, wide * 31)]
    assert found(spark, edges + back) == plain(edges + back)
    assert rounds() <= 60
