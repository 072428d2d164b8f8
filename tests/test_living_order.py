"""Relations rolled up in order, and living graphs that keep what they came with."""

import json
import random

import pytest

from heirloom import cli
from heirloom.operators import living as L

SCHEMA = "no long, src string, tgt string, type string, confidence double, support_count int, directed boolean, symmetric boolean, evidence string, quote string, polarity string"


def join(*parts):
    return " ".join(x for x in parts if x)


def plain(rows):
    out, told = {}, set()
    for _, src, tgt, kind, conf, n, directed, symmetric, ev, own, polarity in sorted(rows):
        if src == tgt:
            continue
        key = (src, tgt, kind.lower(), directed, symmetric)
        ev, own = (ev or "").strip(), (own or "").strip()
        if key not in out:
            out[key] = [conf or 0.0, max(1, n or 1), ev, own, polarity]
            told.add((key, join(ev, own)))
            continue
        row = out[key]
        row[0], row[1] = max(row[0], conf or 0.0), row[1] + max(1, n or 1)
        said = join(ev, own)
        # A text counts where it comes first; that matters only if it ran into the first row's own quote there.
        if said and (key, said) not in told and said not in join(row[2], row[3]):
            row[2] = join(row[2], said)
        told.add((key, said))
    return sorted((*k, c, n, p, join(e, q)) for k, (c, n, e, q, p) in out.items())


@pytest.mark.parametrize("seed", [1, 2])
def test_roll_up_in_order(spark, seed):
    r = random.Random(seed)
    words = ["ab", "abc", "bc", "c", " a ", "", None, "ab bc"]
    rows = [(i, r.choice("xyz"), r.choice("xyz"), r.choice(["Father_of", "father_of", "relative"]), r.choice([None, 0.5, 0.9]), r.choice([None, 0, 3]), r.random() < 0.8, False, r.choice(words), r.choice([*words, None, None]), r.choice(["negative", None])) for i in range(200)]
    got = L.roll_up(spark.createDataFrame(rows, SCHEMA).repartition(4), "no").collect()
    assert sorted((x.src, x.tgt, x.type, x.directed, x.symmetric, x.confidence, x.support_count, x.polarity, x.quote) for x in got) == plain(rows)


def built(spark, tmp_path, relations, *more, people=("a", "b", "c", "d")):
    src = tmp_path / "living_graph.json"
    src.write_text(json.dumps({"entities": [{"entity_id": i, "canonical_name": f"{i.upper()}nna Q{i}", "entity_type": "human", "gender": "male"} for i in people], "relations": relations}))
    out = str(tmp_path / f"out{len(more)}")
    assert cli.main(["build", "--input", str(src), "--output", out, "--graph-mode", "living", *more]) == 0
    return spark.read.schema("src string, tgt string, type string, directed boolean, symmetric boolean, polarity string, inference_rule string").json(f"{out}/relations").collect()


def edge(s, t, kind="father_of", **more):
    return {"source_entity_id": s, "target_entity_id": t, "relation_type": kind, "confidence": 0.9, **more}


def test_equal_fathers_stay_in_order(spark, tmp_path):
    got = built(spark, tmp_path, [edge("c", "d"), edge("b", "d"), edge("a", "d")])
    assert {(x.src, x.type, x.inference_rule) for x in got} == {("a", "father_of", None), ("b", "relative", "parent_role_conflict_downgrade"), ("c", "relative", "parent_role_conflict_downgrade")}


def test_polarity_and_rules_count(spark, tmp_path):
    got = built(spark, tmp_path, [edge("a", "d", polarity="Negative"), edge("b", "d", inference_rule="evidence_parent_cue"), edge("c", "d", inference_rule="told")])
    assert {(x.src, x.type, x.polarity, x.inference_rule) for x in got} == {("c", "father_of", None, "told"), ("b", "relative", None, "evidence_parent_cue;parent_role_conflict_downgrade"), ("a", "relative", "Negative", "parent_role_conflict_downgrade")}


def test_kinship_is_derived_only_if_asked_for(spark, tmp_path):
    relations = [edge("a", "b"), edge("b", "c")]
    assert len(built(spark, tmp_path, relations)) == 2
    got = built(spark, tmp_path, relations, "--derive-kinship")
    assert ("a", "grandfather_of", "c", "two_hop_parent_child") in {(x.src, x.type, x.tgt, x.inference_rule) for x in got}
