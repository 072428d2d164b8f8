"""Kin that several paths lead to come once, against loops over sets; pairs are not shuffled to be told apart."""

import random

from heirloom.operators import living as L

NAMES = {"sibling": "brother_of sister_of sibling_of", "aunt": "uncle_of aunt_of aunt_uncle_of", "niece": "nephew_of niece_of nibling_of", "gp": "grandfather_of grandmother_of grandparent_of", "gc": "grandson_of granddaughter_of grandchild_of", "cousin": "cousin_of cousin_of cousin_of"}


def plain(rel, gender):
    par = {(a, b) for a, t, b in rel if t == "parent_of"}
    av = {(a, b) for a, t, b in rel if t == "uncle_of"} | {(b, a) for a, t, b in rel if t == "niece_of"}
    link = {(u, p) for u, c in av for p, d in par if c == d and u != p}
    link |= {(b, a) for a, b in link}
    sib = {(a, b) for p, a in par for q, b in par if p == q and a != b} | link
    aunt = {(u, c) for p, c in par for q, u in sib if p == q}
    gp = {(x, c) for x, p in par for q, c in par if p == q}
    found = {("sibling", *x) for x in sib} | {("aunt", *x) for x in aunt} | {("niece", c, u) for u, c in aunt} | {("gp", *x) for x in gp} | {("gc", c, x) for x, c in gp}
    found |= {("cousin", c, d) for u, c in aunt for v, d in par if u == v and c != d}
    at = {"male": 0, "female": 1}
    kin = {(a, NAMES[r].split()[at.get(gender[a], 2)], b) for r, a, b in found if a != b}
    kin |= {(p, ("father_of", "mother_of", "parent_of")[at.get(gender[p], 2)], b) for a, b in link for p, c in par if c == a and p != b}
    return kin - {(a, t, b) for a, t, b in rel}


def test_kin_by_many_paths(spark):
    rng = random.Random(3)
    gender = {f"e{i}": rng.choice(["male", "female", None]) for i in range(14)}
    pick = lambda: f"e{rng.randrange(14)}"
    rel = {(pick(), t, pick()) for t in ["parent_of"] * 22 + ["uncle_of", "uncle_of", "niece_of", "sibling_of", "brother_of", "cousin_of", "cousin_of"]}
    rel = sorted(x for x in rel if x[0] != x[2])
    people = spark.createDataFrame([(e, g, None, None) for e, g in gender.items()], "entity_id string, gender string, birth_year int, death_year int")
    for some in (rel, [x for x in rel if x[1] == "parent_of"]):
        df = L.derive_kinship(spark.createDataFrame(some, "src string, type string, tgt string"), people)
        rows = df.select("src", "type", "tgt").collect()
        assert len(rows) == len(set(rows)) and {tuple(r) for r in rows} == plain(some, gender)
    # The last had parents alone: no kin travel to be compared with what is known, but for the parents that would follow.
    assert df._jdf.queryExecution().optimizedPlan().toString().count("LeftAnti") <= 1
