"""Line deduplication against a dictionary of first documents."""

import random

import pytest
from pyspark.sql import functions as F

from heirloom.llm import line_dedup

BLANKS = "\t\n\x0b\x0c\r "
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def key(line):
    return line.strip(BLANKS).translate(LOWER)


def plain(rows):
    """``doc_id, n_lines, n_dropped, kept`` of each row; a null document comes last."""
    place, first, held = lambda d: (d is None, d), {}, {}
    for d, t in rows:
        for line in (t or "").split("\n"):
            k = key(line)
            if len(k) >= 10:
                first[k] = min(first.get(k, place(d)), place(d))
                held.setdefault(k, set()).add(d)
    out = []
    for d, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(held.get(key(x), ())) < 2 or first[key(x)] == place(d)]
        out.append((d, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(map(repr, out))


def ours(df):
    found = line_dedup.drop_repeated_lines(df)
    kept = line_dedup.kept_text(F.col("text"), F.col("keep"))
    return sorted(repr(tuple(r)) for r in found.select("doc_id", "n_lines", "n_dropped", kept).collect())


def corpus(seed, n=150):
    r = random.Random(seed)
    pool = [" Menu: Home | About ", "menu: home | about", "MENU: HOME | ABOUT\r", "ÉTÉ à la plage", "Été à la plage", "été à la plage", "short", "exactly10!", "only nine", "éééééééééé", "\x0b\tprinted in the year 1901\x0c", " printed in the year 1901", "", " "]
    rows = [(r.randrange(1 << 40), "\n".join(r.choice([*pool, f"line of its own {r.random()}", f"rare line {r.randrange(40)}"]) for _ in range(r.randrange(0, 30)))) for _ in range(n)]
    return [*rows, (rows[3][0], rows[5][1]), rows[4], rows[4], (None, rows[6][1]), (None, rows[7][1]), (-5, None), (-6, ""), (-7, "\n\n"), (1 << 41, "menu: home | about\n" * 3000), (2, "x" * 200_000 + "\n" + "menu: home | about")]


@pytest.mark.parametrize("seed", [1, 2])
def test_lines_against_dictionary(spark, seed):
    rows = corpus(seed)
    assert ours(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)) == plain(rows)


def test_frequent_lines_take_the_spread_way(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "SAMPLE_DOCS", 100)
    rows = [(i, f"the line of every page\nline of page {i}\n" + "twice here\n" * 2 + "the line of half the pages" * (i % 2)) for i in range(600)]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    hot = line_dedup.frequent_lines(d.select(F.col("doc_id").alias("doc"), "text"))
    assert 3 <= hot.count() <= line_dedup.HOT_LINES
    assert ours(d) == plain(rows)
    # A sample that finds nothing changes nothing.
    monkeypatch.setattr(line_dedup, "HOT_LINES", 0)
    assert ours(d) == plain(rows)


def test_bitmaps_hold_turns(spark):
    rows = [(1, "aaaaaaaaaaaa\nbbbbbbbbbbbb\ncccccccccccc"), (2, "aaaaaaaaaaaa\nown own own own\nbbbbbbbbbbbb\ncccccccccccc\nlast of all"), (3, "nothing shared")]
    got = {r.doc_id: r.keep for r in line_dedup.drop_repeated_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: [], 2: [0, 1, 2, 4], 3: []}


def test_empty_table_and_clashing_names(spark):
    schema = "doc_id long, text string, doc int, body string, POS int, keep string, _doc int, `a.b` int, salt int, h1 long"
    empty = line_dedup.drop_repeated_lines(spark.createDataFrame([], schema))
    assert empty.collect() == [] and empty.columns == ["doc_id", "text", "doc", "body", "POS", "_doc", "a.b", "salt", "h1", "n_lines", "n_dropped", "keep"]
    got = line_dedup.drop_repeated_lines(spark.createDataFrame([(i, "the very same line", 7, "b", 8, "k", 9, 10, 11, 12) for i in range(3)], schema)).orderBy("doc_id").collect()
    assert [(r.doc, r.body, r.POS, r._doc, r["a.b"], r.salt, r.h1, r.n_dropped) for r in got] == [(7, "b", 8, 9, 10, 11, 12, n) for n in (0, 1, 1)]


def test_no_python_in_the_plan(spark):
    d = spark.createDataFrame(corpus(3, 20), "doc_id long, text string")
    plan = line_dedup.drop_repeated_lines(d)._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))
