"""The keyed store against dictionaries that take the rows one by one."""

import itertools
import random

import pytest

from heirloom.operators import store

MENTION = "number long, name string, birth_year int, birth_place string, death_year int, gender string, aliases array<string>"


def in_memory(batches):
    """The people that the rule makes of all mentions in their order."""
    people = []
    for rows in batches:
        for _, name, y, p, *known, aliases in rows:
            p = p.strip() or None if p else None
            key = (name or "").lower()
            for one in people:
                if one["key"] == key and (y is None or one["y"] in (None, y)) and (p is None or one["p"] in (None, p)):
                    break
            else:
                one = {"key": key, "name": name, "y": None, "p": None, "known": [None, None], "aliases": set()}
                people.append(one)
            one["y"], one["p"] = y if one["y"] is None else one["y"], p if one["p"] is None else one["p"]
            one["known"] = [a if a is not None else b for a, b in zip(one["known"], known, strict=True)]
            one["aliases"] |= set(aliases or [])
    return sorted((one["key"], one["name"], one["y"], one["p"], *one["known"], sorted(one["aliases"])) for one in people)


def key(rows):
    return sorted(map(repr, rows))


@pytest.mark.parametrize("order", [(0, 1, 2), (2, 0, 1), (1, 2, 0, 2)])
def test_batches_in_any_order(spark, tmp_path, order):
    r = random.Random(5)
    batches = [[(i, r.choice(["Ann", "ann", "Bob", "Cy", None]), r.choice([None, 1900, 1950]), r.choice([None, "Rome", " Oslo ", ""]), r.choice([None, None, 1980, 1990]), r.choice([None, "male"]), r.choice([None, [], ["x"], ["y", "x"]])) for i in range(40)] for _ in range(3)]
    folder = str(tmp_path / "s")
    for n, b in enumerate(order):
        store.upsert_people(spark.createDataFrame(batches[b], MENTION).repartition(3), folder, b)
        if n == 1:
            store.compact(spark, folder, store.PEOPLE)
    got = store.people(spark, folder)
    rows = got.collect()
    # A name in two spellings is one person, named as it came first.
    have = [(x.normalized, x.name, x.birth_year, x.birth_place, x.death_year, x.gender, x.aliases) for x in rows]
    want = in_memory(batches)
    assert key([h for h in have if h[0]]) == key([w for w in want if w[0]]) and len(have) == len(want)
    before = key(have)
    store.compact(spark, folder, store.PEOPLE)
    assert len(store._log(spark, folder, store.PEOPLE)) == 1
    assert key([(x.normalized, x.name, x.birth_year, x.birth_place, x.death_year, x.gender, x.aliases) for x in store.people(spark, folder).collect()]) == before


def test_first_last_and_links(spark, tmp_path):
    folder = str(tmp_path / "s")
    media = "number long, media_id string, kind string, path string, caption string"
    writes = [(0, [(0, "m", "image", "/a", "one"), (1, "n", "image", "/b", None)]), (1, [(0, "m", "image", "/c", None), (1, None, "x", "/d", "e")])]
    for order in itertools.permutations(writes):
        at = f"{folder}{order[0][0]}"
        for batch, rows in order:
            store.upsert(spark.createDataFrame(rows, media), at, store.MEDIA, batch)
        found = {x.media_id: (x.path, x.caption) for x in store.read(spark, at, store.MEDIA).collect()}
        assert found == {"m": ("/c", None), "n": ("/b", None), None: ("/d", "e")}  # the latest row counts, its nulls too
        store.upsert(spark.createDataFrame([(0, ["a", "b"], "couple"), (1, ["a", "b"], "other")], "number long, parent_ids array<string>, family_type string"), at, store.FAMILIES, 0)
        assert [tuple(x) for x in store.read(spark, at, store.FAMILIES).collect()] == [(["a", "b"], "couple")]
    links = spark.createDataFrame([(i, "child", "f", f"p{i % 2}") for i in range(6)], "number long, kind string, source_id string, target_id string")
    store.upsert(links, folder, store.LINKS, 0)
    store.upsert(links, folder, store.LINKS, 1)
    assert sorted(x.target_id for x in store.read(spark, folder, store.LINKS).collect()) == ["p0", "p1"]
    store.upsert(links.limit(0), folder, store.CLAIMS, 0)  # rows without the table's columns have none of its keys
    assert store.read(spark, folder, store.CLAIMS).collect() == []


def test_a_write_that_breaks_off_is_not_read(spark, tmp_path):
    folder = str(tmp_path / "s")
    with pytest.raises(LookupError):
        store.people(spark, folder)
    one = spark.createDataFrame([(0, "Ann", 1900, None, None, None, None)], MENTION)
    store.upsert_people(one, folder, 0)
    # As a job that ended between its rows and its line in the log.
    one.write.parquet(f"{folder}/people/lost")
    assert store.people(spark, folder).count() == 1


def test_clashing_columns(spark, tmp_path):
    rows = spark.createDataFrame([(0, "Ann", 1900, "z", "z"), (1, "Ann", None, "z", "z")], "number long, name string, birth_year int, seen string, at string")
    store.upsert_people(rows, str(tmp_path / "s"), 0)
    (x,) = store.people(spark, str(tmp_path / "s")).collect()
    assert (x.name, x.birth_year, x.birth_place, x.aliases) == ("Ann", 1900, None, [])
