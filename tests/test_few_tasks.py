"""Steps over few rows are few tasks, however many partitions shuffles have."""

import random

import pytest
from pyspark.sql import functions as F

from heirloom.cut import gathered
from heirloom.llm.minhash import near_duplicates
from heirloom.operators.components import connected_components


@pytest.fixture
def tasks(spark):
    """How many tasks ``run`` takes where shuffles have 64 partitions, all kept; with what it returns."""
    fixed = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k) for k in fixed}
    for k, v in fixed.items():
        spark.conf.set(k, v)
    sc = spark.sparkContext

    def count(group, run):
        sc.setJobGroup(group, group)
        got = run()
        told = sc.statusTracker()
        stages = {s for j in told.getJobIdsForGroup(group) for s in told.getJobInfo(j).stageIds}
        return got, sum(i.numCompletedTasks for i in map(told.getStageInfo, stages) if i)

    yield count
    sc._jsc.clearJobGroup()
    for k, v in old.items():
        spark.conf.set(k, v)


def test_components_of_few_edges(spark, tasks):
    edges = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(1000, 1001), (7, 7), (None, 3)], "src long, dst long")
    got, n = tasks("components", lambda: {r.id: r.component for r in connected_components(edges).collect()})
    assert got == {i: 0 for i in range(301)} | {1000: 1000, 1001: 1000}
    assert n < 64 * 6


def test_components_of_more_edges_than_a_task_takes(spark, monkeypatch):
    monkeypatch.setattr("heirloom.operators.components.ROWS_EACH", 50)
    edges = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(1000, 1001)], "src long, dst long")
    assert {r.id: r.component for r in connected_components(edges).collect()} == {i: 0 for i in range(301)} | {1000: 1000, 1001: 1000}


def test_vertices_of_other_types(spark, monkeypatch):
    named = [("b", "é"), ("é", "a"), ("x", "y"), ("y", "Z")]
    for each in (100, 2):
        monkeypatch.setattr("heirloom.operators.components.ROWS_EACH", each)
        assert {r.id: r.component for r in connected_components(spark.createDataFrame(named, "src string, dst string")).collect()} == {"a": "a", "b": "a", "é": "a", "x": "Z", "y": "Z", "Z": "Z"}
        mixed = spark.createDataFrame([(1, 2), (3, 2)], "src int, dst long")
        assert {r.id: r.component for r in connected_components(mixed).collect()} == {1: 1, 2: 1, 3: 1}
        assert connected_components(spark.createDataFrame([], "src long, dst long")).count() == 0


def test_rows_are_gathered(spark):
    df, n = gathered(spark.range(1000).repartition(16), 300)
    assert (n, df.rdd.getNumPartitions(), df.agg(F.sum("id")).first()[0]) == (1000, 4, 499500)
    df, n = gathered(spark.range(0).repartition(16))
    assert (n, df.count(), df.columns) == (0, 0, ["id"])


def test_near_duplicates_of_few_documents(spark, tasks):
    """Texts that drift word by word: components found in one turn go on to others in later ones."""
    r, rows = random.Random(3), []
    for family in range(6):
        w = [f"w{family}x{i}" for i in range(60)]
        for step in range(12):
            rows.append((len(rows), " ".join(w)))
            w[r.randrange(60)] = f"s{family}x{step}"
    r.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got, n = tasks("near", lambda: {x.doc_id: x.component_id for x in near_duplicates(docs, words=4).collect()})
    sets = {k: {tuple(t.split()[i : i + 4]) for i in range(57)} for k, t in rows}
    root = {k: k for k in sets}
    for a in sorted(sets):
        for b in sets:
            if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]) and root[a] != root[b]:
                lo, hi = sorted((root[a], root[b]))
                root = {k: lo if v == hi else v for k, v in root.items()}
    assert got == root
    assert n < 64 * 90
