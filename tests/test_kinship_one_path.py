"""Where one path alone leads to each pair of kin, no hubs are compared for it; where some children have more, theirs are."""

import random

import pytest

from heirloom.operators import living as L
from tests.test_kinship_paths import plain


@pytest.mark.parametrize("more", [0, 4])
@pytest.mark.parametrize("each", [500_000, 5])
def test_children_of_one_parent(spark, monkeypatch, more, each):
    monkeypatch.setattr(L, "PAIRS_EACH", each)
    rng = random.Random(more)
    gender = {f"e{i}": rng.choice(["male", "female", None]) for i in range(40)}
    rel = {(f"e{rng.randrange(i)}", "parent_of", f"e{i}") for i in range(1, 40)} | {("e5", "parent_of", "e0")}
    rel |= {(f"e{rng.randrange(40)}", rng.choice(["parent_of", "uncle_of"]), f"e{rng.randrange(40)}") for _ in range(more)}
    rel = sorted(x for x in rel if x[0] != x[2])
    people = spark.createDataFrame([(e, g, None, None) for e, g in gender.items()], "entity_id string, gender string, birth_year int, death_year int")
    df = L.derive_kinship(spark.createDataFrame(rel, "src string, type string, tgt string"), people)
    rows = df.select("src", "type", "tgt").collect()
    assert len(rows) == len(set(rows)) and {tuple(r) for r in rows} == plain(rel, gender)
    assert bool(more) == ("flatten" in df._jdf.queryExecution().optimizedPlan().toString())
