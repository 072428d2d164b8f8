"""Questions are taken apart once, whatever their number of uses; normalized names are the same by one replacement as by two."""

import pytest
from pyspark.sql import functions as F

from heirloom.functions import text as T
from heirloom.operators import variants
from tests.test_questions_alike import ASKED, PEOPLE, PERSON, plain


def test_normalized_by_one_replacement(spark):
    every = spark.range(1, 0x110000).where("id < 55296 or id > 57343").select(F.decode(F.unhex(F.lpad(F.hex("id"), 8, "0")), "UTF-32").alias("c"))
    said = every.select(F.explode(F.array("c", F.concat(F.lit("A"), "c", F.lit("b ")), F.concat("c", F.lit("- a\t"), "c", "c", F.lit("9")))).alias("x"))
    two = F.trim(F.regexp_replace(F.regexp_replace(F.lower("x"), r"[^\p{L}\p{N}\s]", " "), r"\s+", " "))
    assert said.where(two != T.normalize_name(F.col("x"))).count() == 0


@pytest.mark.parametrize("starts, named", [(10_000, 64), (10_000, 1), (1, 64)])
def test_taken_apart_once(spark, monkeypatch, starts, named):
    monkeypatch.setattr(variants, "STARTS", starts)
    monkeypatch.setattr(variants, "NAMED_STARTS", named)
    people = spark.createDataFrame(PEOPLE, PERSON)
    asked = list(dict(ASKED).items())
    found = variants.resolve_questions(spark.createDataFrame(asked, "question_id string, question string"), people, unique=True)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "question#" not in plan and "regexp_extract_all" not in plan
    want = variants.resolve_questions(spark.createDataFrame(ASKED, "question_id string, question string"), people)
    of = lambda df: {r.question_id: (r.person_id, r.matched_text) for r in df.collect()}
    assert of(want) == plain() and of(found) == plain()
    assert variants.resolve_questions(spark.createDataFrame(asked, "question_id string, question string"), people.limit(0)).count() == 0
