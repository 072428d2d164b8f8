from pyspark.sql import functions as F

from heirloom.functions import text as T
from heirloom.operators import claims as C
from heirloom.operators import documents as D
from heirloom.operators import living as L
from heirloom.operators import llm_claims as LLM
from heirloom.operators import people as P
from heirloom.operators import retrieval as R
from heirloom.operators.components import connected_components


def build(spark, texts):
    chunks = spark.createDataFrame(list(enumerate(texts)), "k long, text string")
    claims = C.extract_claims(chunks)
    roles = C.claim_people(claims)
    people = P.fold_people(roles)
    return chunks, claims, people, P.validate(P.relationships(claims, roles, people), people)


def test_tree_of_two_sentences(spark):
    _, claims, people, rels = build(spark, ["Alice Doe is child of Bob Doe and Carol Smith.", "Bob Doe spouse of Carol Smith."])
    assert claims.count() == 2 and people.count() == 3
    got = [(r.type, r.status) for r in rels.collect()]
    assert sorted(got) == [("parent_of", "accepted"), ("parent_of", "accepted"), ("spouse_of", "accepted")]
    assert P.families(rels, "accepted").count() == 1


def test_noise_and_years(spark):
    _, claims, _, _ = build(spark, ["Alice Smith Line (1900-1980) was child of Bob Smith Branch (1870-1930) and Carol Jones Dynasty (1875-1940)."])
    r = claims.first()
    assert (r.name1, r.birth1, r.death1, r.name2, r.birth2, r.name3) == ("Alice Smith", 1900, 1980, "Bob Smith", 1870, "Carol Jones")


def test_age_gap_and_cycle(spark):
    _, _, _, rels = build(spark, ["Child One (1900-1980) was child of Parent Too Young (1895-1970) and Parent Two (1870-1940)."])
    assert sorted(r.status for r in rels.collect()) == ["accepted", "conflict"]
    _, _, _, rels = build(spark, ["Alice Doe was child of Bob Doe. Bob Doe was child of Alice Doe."])
    assert {(r.status, tuple(r.conflicts)) for r in rels.collect()} == {("conflict", ("parent_cycle",))}


def test_mentions_in_two_scripts(spark):
    df = spark.createDataFrame([(1, "Петр — сын Алексей. Alice Smith (1900-1980)\nIvan"), (2, None)], "k long, text string")
    rows = C.extract_mentions(df).orderBy("mention_no").collect()
    assert [r.surface for r in rows] == ["Петр", "Алексей", "Alice Smith", "Ivan"]
    assert all(r.raw == "Петр — сын Алексей. Alice Smith (1900-1980)\nIvan"[r.span_start : r.span_end] for r in rows)


def test_retrieval_answers_parents(spark):
    chunks, claims, people, rels = build(spark, ["Nicholas Romanov was child of Alexander Romanov and Maria Dagmar.", "Olga Romanov was child of Nicholas Romanov."])
    docs = D.person_documents(people, rels).unionByName(D.relationship_documents(rels, people)).unionByName(D.claim_documents(claims)).unionByName(D.chunk_documents(chunks))
    asked = R.resolve_query(people, "Who are Nicholas Romanov parents?")
    assert (asked.first().name, asked.first().intent) == ("Nicholas Romanov", "parents")
    top = R.top(R.graph_ranked(docs, rels, asked)).collect()
    assert "Nicholas Romanov" in top[0].text and any("Maria Dagmar" in r.text for r in top)


def test_kinship_derivation(spark):
    e = spark.createDataFrame([(x, g, None, None) for x, g in [("gp", "male"), ("p1", "male"), ("p2", "male"), ("c1", "male"), ("c2", None)]], "entity_id string, gender string, birth_year int, death_year int")
    rel = spark.createDataFrame([("gp", "p1"), ("gp", "p2"), ("p1", "c1"), ("p2", "c2")], "src string, tgt string").withColumn("type", F.lit("father_of"))
    got = {(r.src, r.type, r.tgt) for r in L.derive_kinship(rel, e).collect()}
    assert {("p1", "brother_of", "p2"), ("p2", "uncle_of", "c1"), ("c1", "nephew_of", "p2"), ("gp", "grandfather_of", "c1"), ("c1", "grandson_of", "gp"), ("c1", "cousin_of", "c2")} <= got


def test_timeline_reverses(spark):
    e = spark.createDataFrame([("y", "male", 1970, None), ("o", "male", 1940, None)], "entity_id string, gender string, birth_year int, death_year int")
    rel = spark.createDataFrame([("y", "o", "parent_child")], "src string, tgt string, type string")
    r = L.guard_timeline(L.specialise_parents(rel, e), e).first()
    assert (r.src, r.tgt, r.type, r.action) == ("o", "y", "father_of", "reversed")


def test_json_repair_and_ladder(spark):
    assert LLM.repair_json('<think>x</think>```json\n{"a": [1,],}\n```') == '{"a": [1]}'
    assert LLM.repair_json("none") is None and LLM.repair_json(None) is None


def test_components(spark):
    e = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (7, 7), (None, 3)], "src long, dst long")
    got = {r.id: r.component for r in connected_components(e).collect()}
    assert got[40] == 0 and got[101] == 100 and len(got) == 43


def test_scalar_functions(spark):
    r = spark.range(1).select(T.normalize_name(F.lit("O'Neil-Иван  IV")).alias("n"), T.coerce_year(F.lit("ca. 19001")).alias("y"), T.roman_numeral(F.lit("Ivan IV x1")).alias("r"), T.clean_name(F.lit("House")).alias("h")).first()
    assert (r.n, r.y, r.r, r.h) == ("o neil иван iv", 1900, "iv", "House")


def test_registry_imports_without_corpus():
    import __spark_entry__ as e

    assert {"gr_people", "lg_kinship"} <= set(e.queries()) and set(e.oracle_sql()) <= set(e.queries())


def test_conflict_and_family_documents(spark):
    chunks, claims, people, rels = build(spark, ["Child One (1900-1980) was child of Parent Too Young (1895-1970) and Parent Two (1870-1940)."])
    roles = C.claim_people(claims)
    found = P.conflicts(rels, roles, people.where("name <> 'Parent Two'"))
    assert sorted(r.conflict_type for r in found.collect()) == ["implausible_parent_age_gap", "unresolved_claim_person"]
    assert D.conflict_documents(found).where("text like '%age gap%'").count() == 1
    assert [r.text for r in D.family_documents(P.families(rels, "accepted"), people).collect()] == ["Family. Parents: Parent Two. Children: Child One"]
    assert D.mention_documents(C.extract_mentions(chunks)).count() == 3
