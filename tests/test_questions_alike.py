"""Questions with the same phrases are answered once, and phrases that no form can be are not made."""

import re

import pytest

from heirloom.operators import variants

PERSON = "person_id string, name string, normalized string, birth_year int, death_year int, aliases array<string>"
PEOPLE = [("p1", "Ann Bell", "ann bell", None, None, ["Nan"]), ("p2", "Bob  Bell Junior", "bob bell junior", None, None, ["Old Bob"]), ("p3", None, "ann bell", None, None, None)]
ASKED = [("a", "Who were the parents of Ann Bell?"), ("b", "Tell me of Ann Bell!"), ("c", "Old Bob, or Bob Bell Junior"), ("d", "Nobody"), ("e", None), ("f", "nan and old nan"), ("g", "Bell"), ("a", "Old Bob's children")]


def plain():
    forms = {}
    for pid, name, normalized, _, _, aliases in PEOPLE:
        for v in (name, normalized, *(aliases or [])):
            if v:
                v = " ".join(v.lower().split())
                forms[v] = min(pid, forms.get(v, pid))
    best = {}
    for key, text in ASKED:
        t = re.sub(r"[^\w\s]", " ", (text or "").lower()).split()
        for v in {" ".join(t[i:j]) for i in range(len(t)) for j in range(i + 1, len(t) + 1)} & set(forms):
            best[key] = max(best.get(key, (0, "", "")), (len(v.split()), v, forms[v]))
    return {k: (p, v) for k, (_, v, p) in best.items()}


@pytest.mark.parametrize("starts", [10_000, 1])
def test_answers(spark, monkeypatch, starts):
    monkeypatch.setattr(variants, "STARTS", starts)
    found = variants.resolve_questions(spark.createDataFrame(ASKED, "question_id string, question string"), spark.createDataFrame(PEOPLE, PERSON))
    assert {r.question_id: (r.person_id, r.matched_text) for r in found.collect()} == plain()
    assert {r.question_id: r.intent for r in found.collect()}["b"] == "person"
    # Phrases are taken apart without the questions that hold them.
    taken_apart = [x for x in found._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Generate explode(said" in x]
    assert taken_apart and not any("question_id" in x for x in found._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Generate" in x)
