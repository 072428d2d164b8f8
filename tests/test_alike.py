"""Mentions of equal names and years are answered once, and long lists do not go out to each of them."""

from pyspark.sql import functions as F

from heirloom.operators import documents as D
from heirloom.operators import people as P
from heirloom.operators import variants

ROLE = "k long, pattern_no int, match_no int, claim_type string, role int, name string, normalized string, birth_year int, death_year int"
PERSON = "person_id string, name string, normalized string, birth_year int, death_year int"


def namesakes(spark, n):
    return spark.createDataFrame([(f"p{i:03d}", "Ann Bell", "ann bell", 1500 + i, 1560 + i) for i in range(n)], PERSON)


def test_a_role_meets_one_row_however_many_namesakes(spark):
    rows = [(k, 0, 0, "parent_child", 1, "Ann Bell", "ann bell", *(((None, None), (1507, 1567), (1507, 1600))[k % 3])) for k in range(300)] + [(300, 0, 0, "spouse", 1, "No One", "no one", None, None)]
    roles = spark.createDataFrame(rows, ROLE)
    told = {(r.normalized, r.birth_year, r.death_year): r.person_id for r in P.told_apart(roles, namesakes(spark, 40)).collect()}
    assert told == {("ann bell", None, None): "p000", ("ann bell", 1507, 1567): "p007", ("ann bell", 1507, 1600): "p000", ("no one", None, None): None}
    got = {r.k: r.person_id for r in P.resolve_people(roles, namesakes(spark, 40)).collect()}
    assert got == {k: ("p000", "p007", "p000")[k % 3] for k in range(300)} | {300: None}


def test_relationships_of_equal_claims(spark):
    made = "k long, pattern_no int, match_no int, claim_type string, name1 string, birth1 int, death1 int, name2 string, birth2 int, death2 int, name3 string, birth3 int, death3 int"
    one = ("Ann Bell", 1507, 1567, "Bob Bell", None, None, "bob  bell", None, None)
    claims = spark.createDataFrame([(k, 0, 0, "parent_child", *one) for k in range(3)] + [(7, 2, 0, "spouse", "Bob Bell", None, None, "Ann Bell", 1507, None, None, None, None)], made)
    people = namesakes(spark, 9).union(spark.createDataFrame([("q1", "Bob Bell", "bob bell", None, None)], PERSON))
    role = [F.struct(F.lit(i).alias("role"), F.col(f"name{i}").alias("name"), F.lower(F.regexp_replace(f"name{i}", " +", " ")).alias("normalized"), F.col(f"birth{i}").alias("birth_year"), F.col(f"death{i}").alias("death_year")) for i in (1, 2, 3)]
    roles = claims.select("k", "pattern_no", "match_no", "claim_type", F.inline(F.array(*role))).where("name is not null")
    got = sorted(tuple(r) for r in P.relationships(claims, roles, people).collect())
    assert got == [("p007", "spouse_of", "q1", 0.75, 1, ["claim-7-2-0"]), ("q1", "parent_of", "p007", 0.8, 3, ["claim-0-0-0", "claim-1-0-0", "claim-2-0-0"])]
    plan = P.relationships(claims, roles, people).drop("claim_ids")._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list(concat_ws" not in plan


def test_what_is_kept_of_candidates(spark):
    m = spark.createDataFrame([(str(i), "ann bell", y, None) for i, y in enumerate([None, 1503, 1, None])] + [("9", "zed", None, None)], "mention_id string, normalized string, birth_year int, death_year int")
    got = {r.mention_id: (r.n, r.outcome) for r in variants.meet(m, namesakes(spark, 5), {"n": F.size("candidates")}).collect()}
    assert got == {"0": (5, "multiple_matching_people"), "1": (1, "resolved"), "2": (5, "year_mismatch"), "3": (5, "multiple_matching_people"), "9": (0, "no_matching_person")}


def test_candidates_of_a_name_in_another_form(spark):
    people = namesakes(spark, 3).withColumn("aliases", F.array(F.concat(F.lit("Nan "), "person_id")))
    m = spark.createDataFrame([("a", "Ann Bell", "ann bell", None, None), ("b", "Nan p001", "nan p001", None, None)], "mention_id string, surface string, normalized string, birth_year int, death_year int")
    kept = {"n": F.size("candidates"), "who": F.when(F.col("outcome") == "resolved", F.element_at("candidates", 1))}
    found = variants.mention_candidates(m.select("normalized"), variants.meet(m, people, kept), people, listed="n", who=F.col("who"))
    assert sorted((r.normalized, r.mention_id, r.n, r.status) for r in found.collect()) == [("ann bell", "a", 3, "ambiguous"), ("ann bell", "b", 1, "resolved")]


def test_claims_are_counted_once_for_people_of_the_same_forms(spark):
    claims = spark.createDataFrame([(k, 0, 0, "Ann Bell", "Bob", None) for k in range(5)], "k long, pattern_no int, match_no int, name1 string, name2 string, name3 string")
    m = spark.createDataFrame([(str(y), "Ann Bell", "ann bell", y, None) for y in (1500, 1501)], "mention_id string, surface string, normalized string, birth_year int, death_year int")
    rows = P.roll_up_mentions(m, namesakes(spark, 3), claims, claims_as=F.size).collect()
    assert sorted((r.person_id, r.claim_ids, r.mention_ids) for r in rows) == [("p000", 5, ["1500"]), ("p001", 5, ["1501"])]


def test_a_resolution_text_made_before(spark):
    m = spark.createDataFrame([(str(i), "Ann Bell", "ann bell", None, None) for i in range(3)], "mention_id string, surface string, normalized string, birth_year int, death_year int")
    made = P.resolve_mentions(m, namesakes(spark, 2), keep={"text": F.md5(D.resolution_text())}, also=("surface",))
    plain = D.resolution_documents(P.resolve_mentions(m, namesakes(spark, 2)))
    assert sorted(D.resolution_documents(made).select("document_id", "text").collect()) == sorted(plain.select("document_id", F.md5("text").alias("text")).collect())
