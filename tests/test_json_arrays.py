"""JSON arrays cut into small ranges against the standard decoder."""

import json
import random

import pytest

from heirloom.sources import content, json_arrays


@pytest.fixture
def ranges(spark):
    """Files are cut every few bytes."""
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.files.minPartitionNum")
    old = {k: spark.conf.get(k, None) for k in keys}

    def cut(n):
        spark.conf.set(keys[0], str(n))
        spark.conf.set(keys[1], "0")
        spark.conf.set(keys[2], "1")

    yield cut
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def value(r, deep=0):
    kind = r.randrange(7 if deep < 3 else 4)
    if kind == 0:
        return "".join(r.choice('a}{][",\\\n\té ß:') for _ in range(r.randrange(12)))
    if kind < 4:
        return r.choice([None, True, -3, 2.5e10, "", "}", '"', "\\", '\\"}', "[{"])
    if kind == 4:
        return [value(r, deep + 1) for _ in range(r.randrange(4))]
    return {value(r, 3).__str__(): value(r, deep + 1) for _ in range(r.randrange(4))}


def items(spark, path):
    rows = sorted(json_arrays.array_items(spark, str(path)).collect(), key=lambda r: r.pos)
    assert [r.pos for r in rows] == list(range(len(rows)))
    return [json.loads(r.item) for r in rows]


@pytest.mark.parametrize("size", [16, 1 << 20])
def test_against_the_decoder(spark, tmp_path, ranges, size):
    ranges(size)
    r = random.Random(size)
    for i in range(2):
        array = [value(r) for _ in range(r.randrange(5, 20))]
        text = json.dumps(array, indent=r.choice([None, 1]), ensure_ascii=r.random() < 0.5)
        path = tmp_path / f"{i}.json"
        path.write_text(" \n" * (i % 2) + text + "\n" * (i % 3))
        assert items(spark, path) == [x for x in array if isinstance(x, dict)], text


def test_a_file_is_read_by_many_tasks(spark, tmp_path, ranges):
    ranges(1000)
    array = [{"type": "text", "text": f'page {i} says "}}"' * 5, "page_idx": i} for i in range(200)]
    (tmp_path / "x_content_list.json").write_text(json.dumps(array))
    assert json_arrays._pieces(spark, [str(tmp_path)], "*.json").rdd.getNumPartitions() >= 3
    got = sorted(content.content_items(spark, str(tmp_path)).collect(), key=lambda r: r.ordinal)
    assert [(r.ordinal, r.text, r.page_idx) for r in got] == [(i, x["text"], x["page_idx"]) for i, x in enumerate(array)]


GOOD = [("", 0), (" \n ", 0), ("[]", 0), ("[ ]", 0), ("[", 0), ('[1, "}", [{"a": 1}]]', 0), ('[{"a": 1}', 1), ('[{"a": 1},', 1), ('[{"a": 1}, {"b": "]"}\n', 2), ('[{"a": 1}] and more {"b": 2}', 1), ('[[{"x": 1}], {"a": {"b": {}}}, 7]', 1), ("[{}]", 1), ("[{},{}]", 2), ('[1 , {"a": 2}, "x", {"a": 3}]', 2)]
BAD = ['{"a": 1}', '{"a": [{"b": 1}]}', "7", '"x"', '[{"a": 1}, {"b":', '[{"a": 1}, {"b": "x', '[{"a": [1, 2}]', '[{"a": 1}, 7', "{", '[1, [2', '[{"a": {"b": 1}']


@pytest.mark.parametrize("size", [5, 1 << 20])
def test_what_is_forgiven_and_what_is_not(spark, tmp_path, ranges, size):
    ranges(size)
    for i, (text, _) in enumerate(GOOD):
        (tmp_path / f"g{i}.json").write_text(text)
    found = [r.file for r in json_arrays.array_items(spark, str(tmp_path), "g*.json").collect()]
    assert [sum(f.endswith(f"/g{i}.json") for f in found) for i in range(len(GOOD))] == [n for _, n in GOOD]
    for i, text in enumerate(BAD if size > 5 else BAD[5:8]):
        path = tmp_path / f"b{i}.json"
        path.write_text(text)
        with pytest.raises(Exception, match="JSON"):
            items(spark, path)
