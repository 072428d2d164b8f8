from pyspark.sql import functions as F

from heirloom.functions import names as N
from heirloom.functions import text as T
from heirloom.operators import merging as M
from heirloom.operators import promotion as PR
from heirloom.operators import reconcile as RC

ENT = "entity_id string, canonical_name string, entity_type string, gender string, birth_year int, death_year int, confidence double, aliases array<string>"
REL = "src string, tgt string, type string, confidence double, support_count int, directed boolean, symmetric boolean, quote string"


def people(spark, rows):
    return spark.createDataFrame([(i, n, "human", g, b, d, 0.9, []) for i, n, g, b, d in rows], ENT)


def rels(spark, rows):
    return spark.createDataFrame([(s, t, k, c, 1, True, False, q) for s, t, k, c, q in rows], REL)


def test_quote_makes_a_parent(spark):
    e = people(spark, [("m", "Mark King", "male", None, None), ("j", "John King", "male", None, None), ("o", "Олег", "male", None, None), ("i", "Иван Олегович", "male", None, None)])
    r = rels(spark, [
        ("m", "j", "relative", 0.86, "Mark King is the son of John King."), ("m", "j", "relative", 0.95, "They were the son of somebody."), ("m", "j", "knows", 0.5, "Mark King is the son of John King."),
        ("i", "o", "relative", 0.9, "Иван и Олег жили рядом."), ("m", "j", "relative", 0.9, "Mark King, husband and son of John King."), ("m", "x", "relative", 0.9, "son of x"), ("m", None, "relative", 0.9, None),
    ])
    got = [(x.src, x.tgt, x.type, x.promoted) for x in PR.promote_parents(r, e).collect()]
    assert ("j", "m", "parent_child", True) in got and ("o", "i", "parent_child", True) in got
    assert len(got) == 7 and sum(x[3] for x in got) == 2


def test_quote_makes_an_uncle(spark):
    e = people(spark, [("a", "Anna Bell", None, 1900, None), ("u", "Paul Bell", "male", 1860, None)])
    r = rels(spark, [
        ("a", "u", "relative", 0.9, "Anna Bell was a niece of Paul Bell."), ("u", "a", "parent_child", 0.9, "niece ; Anna is daughter of Paul Bell."), ("a", "u", "father_of", 0.9, "His nephew Bill."), ("a", "u", "relative", 0.9, ""),
    ])
    got = sorted((x.src, x.tgt, x.type, x.promoted) for x in PR.promote_avuncular(r, e).collect())
    assert got == sorted([("u", "a", "uncle_of", True), ("u", "a", "parent_child", False), ("u", "a", "uncle_of", True), ("a", "u", "relative", False)])


def test_names(spark):
    r = spark.range(1).select(
        N.patronymic(F.lit("Царевич Иван Алексеевич")).alias("p"), N.patronymic_root(F.lit("алексеевич")).alias("root"), N.patronymic_parent(F.lit("Алексей"), F.lit("Иван Алексеевич")).alias("is"),
        N.first_name(F.lit("Emperor II Paul")).alias("first"), N.name_place(F.lit("Ann Lee"), T.cue_text(F.lit("x annie, ann lee"))).alias("at"), N.token_ratio(F.lit("abcd"), F.lit("bcde")).alias("s"),
    ).first()
    assert (r.p, r.root, r["is"], r.first, r.at, r.s) == ("алексеевич", "алекс", True, "paul", 10, 0.75)


def test_titles_merge(spark):
    e = people(spark, [("romanov_1", "Николай II", "male", 1868, 1918), ("romanov_2", "Император Николай II", None, 1868, None), ("c", "Алексей Николаевич", "male", 1904, None)])
    r = rels(spark, [("romanov_1", "c", "father_of", 0.9, ""), ("romanov_2", "c", "father_of", 0.95, "")])
    merged, mapping = M.merge_entities(e, r)
    got = {x.entity_id: x for x in merged.collect()}
    assert set(got) == {"romanov_1", "c"} and got["romanov_1"].aliases == ["Император Николай II"] and got["romanov_1"].n_merged == 2
    assert [list(x.members) for x in M.merge_groups(mapping).collect()] == [["romanov_1", "romanov_2"]]
    assert {(x.src, x.tgt) for x in M.remap(r, mapping).collect()} == {("romanov_1", "c")}


def test_blocking_finds_what_all_pairs_find(spark):
    import random

    rnd = random.Random(5)
    first = ["ivan", "anna", "иван", "nikolai", "nikolay", "alexandera", "alexanders"]
    names = lambda: " ".join([rnd.choice(["", "Tsar "]) + rnd.choice(first), *rnd.sample(["ii", "iv", "great", "romanov", "petrovich"], rnd.choice([0, 0, 1, 2]))])
    rows = [(f"e{i:03}", names(), rnd.choice(["human", "other_living", "dog", None]), rnd.choice(["male", None, None]), rnd.choice([None, 1500 + rnd.randrange(40)]), None, 0.5, []) for i in range(120)]
    e = spark.createDataFrame(rows, ENT)
    kinds = ["relative", "knows", "father_of", "other"]
    r = rels(spark, [(f"e{rnd.randrange(120):03}", f"e{rnd.randrange(120):03}", rnd.choice(kinds), rnd.choice([0.5, 0.95]), "") for _ in range(150)])
    from heirloom.operators.components import connected_components

    f = M.features(e)
    x = f.select("id", F.struct(*[c for c in f.columns if c != "id"]).alias("x"))
    links = M._links(r)
    near = links.select("a", "b").union(links.select("b", "a")).toDF("i", "h")
    hubs = near.alias("p").join(near.alias("q"), F.expr("p.h = q.h and p.i < q.i")).select(F.col("p.i").alias("a"), F.col("q.i").alias("b"), F.lit(True).alias("hub")).distinct()
    pairs = x.toDF("a", "l").crossJoin(x.toDF("b", "r")).where("a < b").join(links, ["a", "b"], "left").join(hubs, ["a", "b"], "left").na.fill(False)
    like = F.greatest(N.token_ratio(N.token_root(F.col("l.first")), N.token_root(F.col("r.first"))), N.token_ratio(F.col("l.first"), F.col("r.first"))) >= 0.9
    pairs = pairs.withColumn("near", like & (F.col("l.n") == 1) & (F.col("r.n") == 1) & (F.col("anchor") | F.col("hub")))
    want = connected_components(pairs.where(M.same_person("l", "r", F.col("kin"), F.col("anchor"), F.col("near"))), "a", "b")
    got = connected_components(M.merge_edges(e, r), "a", "b")
    parts = lambda df: {(y.id, y.component) for y in df.collect()}
    assert parts(want) == parts(got) and parts(want)


def test_reconcile(spark):
    p = spark.createDataFrame([(0, "Nicholas Romanov Alexandrovich", None, None), (1, "Nicholas Romanov", None, None), (2, "", None, None), (3, None, None, None), (4, "Paul Ivanovich Romanow", 0, None), (5, "Olga", 1800, None)], "seq long, name string, birth_year int, death_year int")
    ref = spark.createDataFrame([(0, "Nicholas Romanov", 1868, 1918), (1, "Paul Ivanovich Romanov", 1754, 1801), (2, "Olga", 1, 2), (3, "Olga", 3, 4), (4, None, 1, 1)], "ref long, name string, birth_year int, death_year int")
    got = {x.seq: x for x in RC.reconcile(p, ref).collect()}
    want = RC._greedy(__import__("pandas").DataFrame([(i.seq, j.ref, s) for i in p.collect() for j in ref.collect() if (s := RC.name_score((i.name or "").lower(), (j.name or "").lower())) >= RC.MATCH], columns=["seq", "ref", "score"]))
    assert {s: r.ref for s, r in got.items() if r.ref is not None} == dict(zip(want["seq"], want["ref"]))
    assert len(got) == 6 and got[5].ref is None and got[5].name == "Olga"


def test_candidates_match_all_pairs(spark):
    import random

    rnd = random.Random(3)
    w = ["ann", "anne", "bell", "carl", "romanov", "romanova", "ivan", "ii"]
    some = lambda: " ".join(rnd.choice(w) for _ in range(rnd.choice([1, 2, 2, 3, 4])))
    a, b = [some() for _ in range(60)], [some() for _ in range(60)]
    p, r = spark.createDataFrame(list(enumerate(a)), "seq long, name string"), spark.createDataFrame(list(enumerate(b)), "ref long, name string")
    got = {(x.seq, x.ref) for x in RC.candidates(p, r).collect()}
    assert got == {(i, j) for i, x in enumerate(a) for j, y in enumerate(b) if RC.name_score(x, y) >= RC.MATCH}
