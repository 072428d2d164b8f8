"""The fold of mentions into people against the rule applied one mention at a time."""

import itertools
import random

import pytest

from heirloom.operators import identity


def plain(mentions):
    """``(person of each mention, what people know)`` of one name's mentions ``(year, place)`` in order."""
    people, out = [], []
    for y, p in mentions:
        for i, (a, b) in enumerate(people):
            if (y is None or a is None or a == y) and (p is None or b is None or b == p):
                people[i] = (y if a is None else a, p if b is None else b)
                break
        else:
            i = len(people)
            people.append((y, p))
        out.append(i)
    return out, people


def test_pairs_in_every_order():
    pairs = list(itertools.product((None, 1900, 1950), (None, "Rome", "Oslo")))
    for n in (1, 2, 3, 4):
        for some in itertools.permutations(pairs, n):
            assert identity.fold_pairs(list(some)) == plain(some)[0]
    r = random.Random(1)
    for _ in range(200):
        some = [(r.choice([None, *range(20)]), r.choice([None, *"abcdef"])) for _ in range(r.randrange(200))]
        some = list(dict.fromkeys(some))
        assert identity.fold_pairs(some) == plain(some)[0]


def test_a_repeated_pair_goes_where_it_went():
    r = random.Random(2)
    for _ in range(300):
        some = [(r.choice([None, 1, 2, 3]), r.choice([None, "a", "b", "c"])) for _ in range(60)]
        went = dict(zip(some[::-1], plain(some)[0][::-1], strict=True))
        assert plain(some)[0] == [went[x] for x in some]


SCHEMA = "seq long, name string, normalized string, birth_year int, death_year int, birth_place string, death_place string, gender string, aliases array<string>"


@pytest.mark.parametrize("seed", [1, 2])
def test_people_against_the_rule(spark, seed):
    r = random.Random(seed)
    names = ["ann", "bob", "no place", None, *[f"n{i}" for i in range(30)]]
    rows = [(i, f"{n}-{i}", n, r.choice([None, 1900, 1950, 1960]), r.choice([None, 1999]), None if n == "no place" else r.choice([None, "Rome", "Oslo"]), r.choice([None, "Bonn", "Kiel"]), r.choice([None, "male"]), r.choice([None, [], ["x"], ["y", "x"]])) for i, n in enumerate(r.choice(names) for _ in range(400))]
    want = []
    for n in {x[2] for x in rows}:
        mine = [x for x in rows if x[2] == n]
        at, known = plain([(x[3], x[5]) for x in mine])
        for i, (y, p) in enumerate(known):
            own = [x for x, a in zip(mine, at, strict=True) if a == i]
            first = lambda c: next((x[c] for x in own if x[c] is not None), None)  # noqa: E731, B023
            want.append((own[0][1], n, y, p, first(4), first(6), first(7), sorted({a for x in own for a in x[8] or []}), i + 1))
    got = identity.fold_people(spark.createDataFrame(rows, SCHEMA).repartition(5), ("seq",)).collect()
    assert sorted(map(repr, want)) == sorted(repr((x.name, x.normalized, x.birth_year, x.birth_place, x.death_year, x.death_place, x.gender, x.aliases, int(x.person_id[-4:]))) for x in got)
    assert identity.fold_people(spark.createDataFrame([], SCHEMA), ("seq",)).collect() == []
