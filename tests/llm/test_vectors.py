"""Vector codes and clusters against plain loops over Python integers."""

import hashlib
import math
import random

import numpy as np
import pytest

from heirloom.llm import codes, lloyd, queries, vectors

SCHEMA = "vec_id long, embedding array<float>, label int"


def floats(seed, n, width=16):
    r = random.Random(seed)
    middles = [[r.uniform(-1, 1) for _ in range(width)] for _ in range(5)]
    return [(3 * i + 1, [float(np.float32(m + r.gauss(0, 0.1))) for m in r.choice(middles)], r.choice([0, 1, None])) for i in range(n)]


def odd_rows(width=16):
    good = floats(4, 40, width)
    return [*good, good[7], good[7], (None, good[3][1], 1), (900, None, 0), (901, [None, *good[0][1][1:]], 0), (902, [math.nan, *good[0][1][1:]], 0), (903, [math.inf, *good[0][1][1:]], 0), (904, [], 0), (905, good[0][1][:5], 0)]


def usable(rows, width):
    return [r for r in rows if r[1] is not None and len(r[1]) == width and all(x is not None and math.isfinite(x) for x in r[1])]


def square(a, b):
    return sum((x - y) ** 2 for x, y in zip(a, b, strict=True))


def rounds_of(points, centres, rounds):
    """Plain Lloyd over lists of integers."""
    near = lambda p: min((square(p, c), i) for i, c in enumerate(centres))  # noqa: E731, B023
    for _ in range(rounds):
        at = [near(p)[1] for p in points]
        centres = [[sum(x) // len(x) for x in zip(*[p for p, a in zip(points, at, strict=True) if a == i], strict=True)] if i in at else c for i, c in enumerate(centres)]
    return [near(p)[::-1] for p in points], centres


def by_id(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0], r[1]))


def test_nearest_keeps_ties_and_smallest_distances():
    r = np.random.default_rng(1)
    for width in (1, 2, 3, 7, 8, 16):
        for spread in (2, 50, 1 << 27):
            book = r.integers(-spread, spread, (16, width))
            book[9] = book[4]
            x = np.concatenate([r.integers(-spread, spread, (200, width)), book, (book[:8] + book[8:]) // 2])
            d = ((x[:, None, :] - book[None]) ** 2).sum(2)
            near, least, taken = codes.nearest(x, book)
            assert (near == d.argmin(1)).all() and (least == d.min(1)).all() and (taken >= 1).all()
    assert all(len(a) == 0 for a in codes.nearest(np.zeros((0, 4), np.int64), np.zeros((2, 4), np.int64)))


def test_bounds_leave_few_exact_distances():
    x = np.array([[math.floor(4096 * v) for v in e] for _, e, _ in floats(2, 500)])
    book = x[:16]
    assert codes.nearest(x, book)[2].mean() < 8


def test_codes_against_loops(spark):
    rows = odd_rows()
    found, books = codes.compress(spark.createDataFrame(rows, SCHEMA).repartition(3), parts=4, entries=6, rounds=3)
    kept = by_id(usable(rows, 16))
    ints = [[math.floor(4096 * x) for x in r[1]] for r in kept]
    want, final = [["", 0] for _ in kept], []
    for p in range(4):
        part = [v[4 * p : 4 * p + 4] for v in ints]
        at, centres = rounds_of(part, part[:6], 3)
        final += [x for c in centres for x in c]
        for w, (i, d) in zip(want, at, strict=True):
            w[0] += f"{i:02x}"
            w[1] += d
    got = found.collect()
    assert sorted(map(repr, ((r.vec_id, r.code, r.error) for r in got))) == sorted(map(repr, ((r[0], *w) for r, w in zip(kept, want, strict=True))))
    assert codes.books_sha256(books) == hashlib.sha256(",".join(map(str, final)).encode()).hexdigest()


def test_clusters_against_loops(spark):
    rows = odd_rows()
    found, centroids = lloyd.cluster(spark.createDataFrame(rows, SCHEMA).repartition(3), clusters=4, width=16, rounds=5)
    kept = sorted(usable(rows, 16), key=lambda r: (hashlib.sha256(f"3:{'null' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    ints = [[math.floor(1024 * x) for x in r[1]] for r in kept]
    at, centres = rounds_of(ints, ints[:4], 5)
    assert centroids.tolist() == centres
    assert sorted(map(repr, ((r.vec_id, r.cluster, r.distance) for r in found.collect()))) == sorted(map(repr, ((r[0], *a) for r, a in zip(kept, at, strict=True))))


def test_empty_clusters_and_few_rows(spark):
    same = [(i, [1.0, 2.0], None) for i in range(9)]
    d = spark.createDataFrame(same, SCHEMA)
    found, centroids = lloyd.cluster(d, clusters=3, width=2, rounds=4)
    assert {(r.cluster, r.distance) for r in found.collect()} == {(0, 0)} and centroids.tolist() == [[1024, 2048]] * 3
    found, books = codes.compress(d, parts=2, entries=16)
    assert {(r.code, r.error) for r in found.collect()} == {("0000", 0)} and [len(b) for b in books] == [9, 9]


@pytest.mark.parametrize("rows", [[], [(1, None, 1)], [(1, [math.nan] * 16, 1)]])
def test_nothing_usable(spark, rows):
    d = spark.createDataFrame(rows, SCHEMA)
    found, books = codes.compress(d)
    assert found.collect() == [] and books == [] and found.columns == ["vec_id", "embedding", "label", "code", "error", "n_exact"]
    found, centroids = lloyd.cluster(d, width=16)
    assert found.collect() == [] and len(centroids) == 0


def test_clashing_and_odd_names(spark):
    rows = [(i, [float(i), 1.0], 7, "x", -1, i) for i in range(5)]
    d = spark.createDataFrame(rows, "vec_id long, embedding array<double>, v int, Error string, cluster int, `a.b` int")
    got = codes.compress(d, parts=2)[0]
    assert got.columns == ["vec_id", "embedding", "v", "cluster", "a.b", "code", "error", "n_exact"] and {r["a.b"] for r in got.collect()} == set(range(5))
    got = lloyd.cluster(d, width=2)[0]
    assert got.columns == ["vec_id", "embedding", "v", "Error", "a.b", "cluster", "distance"] and {r.v for r in got.collect()} == {7}


def test_group_sums_with_a_frequent_group(spark, monkeypatch):
    monkeypatch.setattr(vectors, "HOT_SHARE", 4)
    rows = [(i, None if i % 11 == 0 else "hot" if i % 2 else f"g{i % 7}", i * i, 5) for i in range(200)]
    got = vectors.with_group_sum(spark.createDataFrame(rows, "id long, label string, error long, _n int"), "label", "error", "total").collect()
    want = {}
    for _, g, x, _ in rows:
        want[g] = want.get(g, 0) + x
    assert len(got) == 200 and all(r.total == want[r.label] and r._n == 5 for r in got)


def test_queries_over_a_folder(spark, tmp_path):
    rows = [(k, [x * (1 + k % 3) for x in v], g) for k, v, g in floats(6, 60, 64)] + [(777, None, None)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/embeddings.parquet")
    got = queries.op11_vector_codes(spark, str(tmp_path)).collect()
    totals = {}
    for r in got:
        g = next(g for k, _, g in rows if k == r.vec_id)
        totals[g] = totals.get(g, 0) + r.error
    assert len(got) == 60 and all(r.label_error == totals[next(g for k, _, g in rows if k == r.vec_id)] for r in got)
    got = queries.op12_lloyd(spark, str(tmp_path)).collect()
    assert len(got) == 60 and {r.inertia for r in got} == {sum(r.distance for r in got)}
    for c in {r.cluster for r in got}:
        assert {r.cluster_inertia for r in got if r.cluster == c} == {sum(r.distance for r in got if r.cluster == c)}
