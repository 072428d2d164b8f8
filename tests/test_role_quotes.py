"""Equal quotes about equal names are judged once, and as each row would be."""

import pytest

from heirloom.operators import living as L


@pytest.mark.parametrize("judged", [200_000, 0])
def test_equal_quotes(spark, monkeypatch, judged):
    monkeypatch.setattr(L, "JUDGED", judged)
    counted = []
    monkeypatch.setattr(L, "gathered", lambda df, f=L.gathered: counted.append(f(df)) or counted[-1])
    said = (None, "He was a son of Zorro, they say.", "")
    rows = [(c * 100 + i, 1000 + i, c, "father_of", 0.5, said[(i + c) % 3]) for c in range(9) for i in range(12)] + [(9999, None, 3, "father_of", 0.9, None)]
    rel = spark.createDataFrame(rows, "relation_id long, src long, tgt long, type string, confidence double, quote string").selectExpr("*", "true as directed", "false as symmetric")
    people = spark.createDataFrame([(i, "Quill") for i in range(9)] + [(1000 + i, ("Zorro", "Quill")[i % 2]) for i in range(12)], "entity_id long, canonical_name string")
    kept, conflicts = L.resolve_role_conflicts(rel, people)
    # Ahead stays who the quote names; nobody named counts for less than no quote.
    rank = lambda r: (-(0 if not r[5] else 2 if r[1] % 2 == 0 else -1), -r[4], -len(r[5] or ""), r[0])
    want = {min((r for r in rows if r[2] == c), key=rank)[0] for c in range(9)}
    assert {r.relation_id for r in kept.where("not demoted").collect()} == want
    assert conflicts.count() == 9
    assert [n for _, n in counted] == [5]
