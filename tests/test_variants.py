"""Names and aliases against plain loops over people, mentions and questions."""

import random

from pyspark.sql import functions as F

from heirloom.functions import text as T
from heirloom.operators import people as P
from heirloom.operators import retrieval as R
from heirloom.operators import variants

PEOPLE = "person_id string, name string, normalized string, birth_year int, death_year int, aliases array<string>"
MENTIONS = "mention_id string, surface string, normalized string, birth_year int, death_year int"
WORDS = ["ann", "bob", "lee", "ray"]


def plain_forms(p):
    return {" ".join("".join(c if c.isalnum() else " " for c in (x or "").lower()).split()) for x in (p[1], p[2], *(p[5] or []))} - {""}


def some_people(r, n):
    name = lambda: " ".join(r.choice(WORDS) for _ in range(r.randrange(1, 4)))
    return [(f"p{i:03}", r.choice([name().title(), None]), r.choice([name(), None]), r.choice([None, 1900, 1901]), r.choice([None, 1950]), r.choice([None, [], [name().upper() + "!", None, ""], [name(), name()]])) for i in range(n)]


def test_mentions_against_a_loop(spark):
    r = random.Random(3)
    people = some_people(r, 40)
    mentions = [(f"m{i:03}", "s", r.choice([None, "", "nobody", *[" ".join(r.choice(WORDS) for _ in range(r.randrange(1, 4))) for _ in range(9)]]), r.choice([None, 1900, 1902]), r.choice([None, 1950, 1951])) for i in range(200)]
    want = {}
    for m in mentions:
        every = [p for p in people if m[2] and m[2] in plain_forms(p)]
        fit = [p for p in every if all(a is None or b is None or a == b for a, b in zip(m[3:], p[3:5], strict=True))]
        why = "no_matching_person" if not every else "year_mismatch" if not fit else "multiple_matching_people" if len(fit) > 1 else "resolved"
        want[m[0]] = (why, [p[0] for p in fit or every])
    df, md = spark.createDataFrame(people, PEOPLE), spark.createDataFrame(mentions, MENTIONS)
    got = {x.mention_id: (x.outcome, x.candidates) for x in P.resolve_mentions(md, df).collect()}
    assert got == want and {w[0] for w in want.values()} == {"no_matching_person", "year_mismatch", "multiple_matching_people", "resolved"}
    assert {x.outcome for x in P.resolve_mentions(md, df.limit(0)).collect()} == {"no_matching_person"} and not P.resolve_mentions(md.limit(0), df).collect()


def test_an_alias_alone_resolves_and_carries_claims(spark):
    people = spark.createDataFrame([("p1", "Ida Lund", "ida lund", None, None, ["Countess Ida"]), ("p2", "Karl", "karl", None, None, None)], PEOPLE)
    m = spark.createDataFrame([("m1", "Countess IDA", "countess ida", None, None), ("m2", "Nils", "nils", None, None)], MENTIONS)
    claims = spark.createDataFrame([(1, 0, 0, "Countess Ida", "Karl", None, "q"), (2, 0, 0, "Nils", "Ida Lund", None, "q")], "k long, pattern_no int, match_no int, name1 string, name2 string, name3 string, quote string")
    (r,) = P.roll_up_mentions(m, people, claims).collect()
    assert (r.person_id, r.surfaces, r.claim_ids) == ("p1", ["Countess IDA"], ["claim-1-0-0", "claim-2-0-0"])
    asked = R.resolve_query(people, "Who were the parents of countess Ida?").first()
    assert (asked.person_id, asked.matched_text, asked.intent) == ("p1", "countess ida", "parents")
    by_surface = R.resolve_query(people, "and old Charly?", spark.createDataFrame([("p2", ["Charly"]), ("p9", ["old Charly"])], "person_id string, surfaces array<string>")).first()
    assert (by_surface.person_id, by_surface.matched_text) == ("p2", "charly")


def test_mentions_listed_for_a_name(spark):
    people = spark.createDataFrame([("p1", "Ida Lund", "ida lund", None, None, ["Countess"]), ("p2", "Karl", "karl", None, None, None), ("p3", "Karl", "karl", None, None, None)], PEOPLE)
    m = spark.createDataFrame([("m1", "Countess", "countess", None, None), ("m2", "Karl", "karl", None, None), ("m3", "Nils", "nils", None, None)], MENTIONS)
    names = spark.createDataFrame([("ida lund",), ("karl",), ("karl",), ("countess",), ("",), (None,)], "normalized string")
    rows = variants.mention_candidates(names, variants.meet(m, people), people).collect()
    # m1 is listed under its person's name, not under the alias it has.
    assert sorted((x.normalized, x.mention_id, x.surface, x.candidates, x.status, x.reason) for x in rows) == [("ida lund", "m1", None, ["p1"], "resolved", "normalized_name_match"), ("karl", "m2", "Karl", ["p2", "p3"], "ambiguous", "multiple_matching_people")]


def test_questions_against_a_loop(spark):
    r = random.Random(4)
    people = some_people(r, 12)
    questions = [(i, " ".join(r.choice([*WORDS, "who", "is", "parent", "wife"]) for _ in range(r.randrange(8))) + "?") for i in range(150)] + [(900, None), (901, "")]
    want = {}
    for k, text in questions:
        padded = f" {(text or '').rstrip('?')} "
        found = [(len(v.split()), v, p[0]) for p in people for v in plain_forms(p) if f" {v} " in padded]
        if found:
            n, v, _ = max(found, key=lambda x: x[:2])
            want[k] = (min(x[2] for x in found if x[1] == v), v, round(0.7 + min(0.25, 0.04 * n), 9), "parents" if " parent " in padded else "spouses" if " wife " in padded else "person")
    df = spark.createDataFrame(people, PEOPLE)
    q = spark.createDataFrame(questions, "question_id int, question string")
    got = {x.question_id: (x.person_id, x.matched_text, round(x.confidence, 9), x.intent) for x in variants.resolve_questions(q, df).collect()}
    assert got == want and len(want) > 50
    one = questions[min(want)][1]
    x = R.resolve_query(df, one).first()
    assert (x.person_id, x.matched_text) == want[min(want)][:2]
    assert variants.resolve_questions(q, df.limit(0)).collect() == [] and variants.resolve_questions(q.limit(0), df).collect() == []


def test_a_common_form_meets_one_row(spark):
    people = spark.range(300).select(F.format_string("p%03d", "id").alias("person_id"), F.lit("Ann").alias("name"), F.lit("ann").alias("normalized"), (1500 + F.col("id")).cast("int").alias("birth_year"), F.lit(None).cast("int").alias("death_year"))
    assert variants.index(people).count() == 1
    m = spark.range(500).select(F.col("id").alias("mention_id"), F.lit("Ann").alias("surface"), T.normalize_name(F.lit("Ann")).alias("normalized"), (1500 + F.col("id")).cast("int").alias("birth_year"), F.lit(None).cast("int").alias("death_year"))
    found = {x.outcome: x["count"] for x in P.resolve_mentions(m, people).groupBy("outcome").count().collect()}
    assert found == {"resolved": 300, "year_mismatch": 200}
