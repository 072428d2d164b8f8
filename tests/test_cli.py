import json

from heirloom import cli
from heirloom.operators import expand as X


def test_tree_and_exports(spark, tmp_path):
    src = tmp_path / "a_content_list.json"
    src.write_text(json.dumps([{"type": "text", "text": "Alice Doe is child of Bob Doe and Carol Smith.", "page_idx": 0}, {"type": "text", "text": "Bob Doe spouse of Carol Smith.", "page_idx": 1}, 7]))
    out = str(tmp_path / "out")
    assert cli.main(["build", "--input", str(src), "--output", out]) == 0
    people = spark.read.json(f"{out}/people")
    assert people.count() == 3 and spark.read.json(f"{out}/families").count() == 1
    for fmt in cli.FORMATS:
        assert cli.main(["export", "--input", out, "--format", fmt, "--output", f"{out}/{fmt}"]) == 0
    gedcom = [r.value for r in spark.read.text(f"{out}/gedcom").collect()]
    assert "1 NAME Alice Doe" in gedcom and "0 TRLR" in gedcom
    assert cli.main(["llm-extract", "--input", out, "--output", f"{out}/cand"]) == 0 and spark.read.json(f"{out}/cand/candidates").count() == 2


def test_living_graph(spark, tmp_path):
    src = tmp_path / "living_graph.json"
    e = [{"entity_id": i, "canonical_name": n, "entity_type": "human", "gender": g, "birth_year": b} for i, n, g, b in [("j", "John King", "male", 1900), ("m", "Mark King", "male", 1930), ("p", "Paul King", "male", 1933)]]
    r = [
        {"source_entity_id": "m", "target_entity_id": "j", "relation_type": "relative", "confidence": 0.86, "evidence": [{"quote": "Mark King is the son of John King."}]},
        {"source_entity_id": "j", "target_entity_id": "p", "relation_type": "parent_child", "confidence": 0.9},
    ]
    src.write_text(json.dumps({"entities": e, "relations": r}))
    out = str(tmp_path / "out")
    assert cli.main(["build", "--input", str(src), "--output", out, "--graph-mode", "living", "--derive-kinship"]) == 0
    got = {(x.src, x.type, x.tgt) for x in spark.read.json(f"{out}/relations").collect()}
    assert got == {("j", "father_of", "m"), ("j", "father_of", "p"), ("m", "brother_of", "p"), ("p", "brother_of", "m")}
    dot = [x.value for x in spark.read.text(f"{out}/living_graph.dot").collect()]
    assert dot[0] == "digraph living_graph {" and any("cluster_birth_1930" in x for x in dot) and dot[-1] == "}"


CLAIMS = "task_type string, subject string, claim_no int, claim_type string, p1 string, p2 string, p3 string"


def test_expansion(spark):
    fam = spark.range(1).select(X.family_id(*[__import__("pyspark").sql.functions.lit(x) for x in ("bob", "carol")])).first()[0]
    rows = [
        ("find_parents", "alice", 0, "parent_child", "alice", "bob", "carol"),
        ("find_parents", "bob", 0, "parent_child", "bob", "david", "emma"),
        ("find_children", fam, 0, "parent_child", "frank", "bob", "carol"),
        ("find_profile", "david", 0, "person_profile", "david", None, None),
        ("find_spouses", "alice", 0, "spouse", "alice", None, None),
    ]
    claims = spark.createDataFrame(rows, CLAIMS)
    tasks, applied = X.expand(claims, "alice", max_depth=4)
    s = X.summary(tasks, applied, "alice").first()
    assert (s.people, s.families, s.claims_written) == (6, 2, 4)
    order = [(t.kind, t.subject) for t in tasks.orderBy("pos").collect()]
    assert order[:5] == [("find_parents", "alice"), ("find_profile", "alice"), ("find_children", fam), ("find_parents", "bob"), ("find_profile", "bob")] and len(set(order)) == len(order)
    tasks, _ = X.expand(claims, "alice", max_depth=4, max_tasks=4)
    assert tasks.count() == 4
