"""Command line: ``python -m heirloom.cli build|export|llm-extract``.  All files are written by Spark, in parallel."""

from __future__ import annotations

import argparse
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from heirloom.cut import cut
from heirloom.functions import names as N
from heirloom.operators import claims as C
from heirloom.operators import documents as D
from heirloom.operators import living as L
from heirloom.operators import llm_claims as LLM
from heirloom.operators import llm_pipeline as LP
from heirloom.operators import merging as M
from heirloom.operators import people as P
from heirloom.operators import promotion as PR
from heirloom.operators import reconcile as RC
from heirloom.operators.order import numbered
from heirloom.sources import content, sinks

ENTITIES = "entity_id string, canonical_name string, entity_type string, gender string, birth_year int, death_year int, confidence double, aliases array<string>"
RELATIONS = "relation_id string, source_entity_id string, target_entity_id string, relation_type string, confidence double, support_count int, directed boolean, symmetric boolean, evidence array<struct<quote:string,page_idx:int>>, quote string, polarity string, inference_rule string"
FORMATS = ("dot", "json", "gedcom", "html")


def build_tree(spark: SparkSession, source: str, out: str, reference: str = "") -> dict[str, DataFrame]:
    """Claims, people, relationships, families, mentions, resolution, conflicts and documents from content lists."""
    place = F.concat_ws("|", "source_path", F.lpad(F.col("ordinal").cast("string"), 10, "0"))
    chunks = cut(content.chunks(content.content_items(spark, source)).withColumn("k", place))
    claims = cut(C.extract_claims(chunks))
    roles = C.claim_people(claims)
    people = cut(P.fold_people(roles))
    rels = cut(P.validate(P.relationships(claims, roles, people), people))
    mentions = cut(C.extract_mentions(chunks).withColumn("mention_id", F.concat_ws("-", F.lit("mention"), "k", "mention_no")))
    resolved = P.resolve_mentions(mentions, people)
    families = P.families(rels, "accepted")
    conflicts = P.with_conflict_ids(P.conflicts(rels, roles, people))
    docs = D.person_documents(people, rels).unionByName(D.relationship_documents(rels, people)).unionByName(D.claim_documents(claims)).unionByName(D.chunk_documents(chunks))
    docs = docs.unionByName(D.family_documents(families, people)).unionByName(D.conflict_documents(conflicts)).unionByName(D.mention_documents(mentions)).unionByName(D.resolution_documents(resolved))
    named = people
    if reference:
        named = RC.reconcile(numbered(people, "person_id", "seq"), content.reference_people(spark, reference)).drop("seq", "ref")
    tables = {
        "source_chunks": chunks, "sources": chunks.select("source_id", F.col("source_path").alias("path")).distinct(), "claims": claims, "evidences": P.evidences(claims, "chunk_id" if "chunk_id" in claims.columns else "k"),
        "people": named, "relationships": rels, "families": families, "mentions": mentions, "resolution": P.roll_up_mentions(mentions, people, claims), "unresolved_mentions": resolved.where("outcome <> 'resolved'"), "conflicts": conflicts, "documents": docs,
    }
    for name, df in tables.items():
        sinks.write_jsonl(df, f"{out}/{name}")
    return tables


def living_rules(entities: DataFrame, rel: DataFrame, derive: bool = False) -> dict[str, DataFrame]:
    """Merge, roll-up, quotes, time line, roles and, if asked for, derived kinship, in this order.

    ``rel`` has ``src, tgt, type, confidence, support_count, directed, symmetric, relation_no`` (the order in which relations
    came) and, where there are any, ``evidence, quote, polarity, inference_rule``.
    Returns ``entities, relations`` and what was mended: ``merge_groups, repairs, role_conflicts``.
    """
    entities, mapping = M.merge_entities(entities, rel)
    entities, rel = cut(entities), M.remap(rel, mapping)
    for c in ("polarity", "inference_rule"):
        rel = rel if c in rel.columns else rel.withColumn(c, F.lit(None).cast("string"))
    # What a relation was rolled up by is its place from now on, whatever becomes of its ends and type.
    place = {f"_{c}": F.col(c) for c in ("src", "tgt", "type", "directed", "symmetric")}
    r = L.roll_up(cut(rel), "relation_no").withColumns(place)
    r = PR.promote_parents(r, entities)
    r = r.withColumns({"inference_rule": F.when(F.col("promoted"), F.coalesce("inference_rule", F.lit("evidence_parent_cue"))).otherwise(F.col("inference_rule"))}).drop("promoted")
    r = L.specialise_parents(r, entities)
    r = PR.promote_avuncular(r, entities)
    r = r.withColumns({"inference_rule": L.append_rule("evidence_avuncular_cue", F.col("promoted"))}).drop("promoted")
    r = L.guard_timeline(r, entities)
    turned, lowered = (F.coalesce(F.col("action") == x, F.lit(False)) for x in ("reversed", "downgraded"))
    r = r.withColumn("inference_rule", L.append_rule("parent_timeline_reverse", turned)).withColumn("inference_rule", L.append_rule("parent_timeline_downgrade", lowered))
    r = cut(r.withColumns({"directed": F.when(turned, True).when(lowered, False).otherwise(F.col("directed")), "symmetric": F.when(turned, False).when(lowered, True).otherwise(F.col("symmetric"))}))
    repairs = r.where("action is not null").select("src", "tgt", "type", "action", "reasons")
    r, conflicts = L.resolve_role_conflicts(r.drop("action", "reasons"), entities, tie=tuple(place))
    r = cut(r.select("src", "tgt", "type", "confidence", "support_count", "directed", "symmetric", "relation_id", "polarity", "inference_rule", "quote"))
    if derive:
        r = r.unionByName(L.derive_kinship(r, entities), allowMissingColumns=True)
    return {"entities": entities, "relations": r, "merge_groups": M.merge_groups(mapping), "repairs": repairs, "role_conflicts": conflicts}


def build_living(spark: SparkSession, source: str, out: str, max_relations: int = 400, include: str = "", exclude: str = "", derive: bool = False) -> dict[str, DataFrame]:
    """A living graph's entities and relations after all rules, conflicts, DOT and HTML."""
    entities, raw = content.living_graph(spark, source, ENTITIES, RELATIONS)
    rel = raw.select("relation_no", F.trim("source_entity_id").alias("src"), F.trim("target_entity_id").alias("tgt"), F.col("relation_type").alias("type"), "confidence", "support_count", F.coalesce("directed", F.lit(True)).alias("directed"), F.coalesce("symmetric", F.lit(False)).alias("symmetric"), N.relation_quote("evidence", None).alias("evidence"), "quote", "polarity", "inference_rule")
    made = living_rules(entities, cut(rel), derive)
    entities, rel = made["entities"], cut(L.filter_types(made["relations"], L.type_list(include), L.type_list(exclude)))
    made["relations"] = rel
    for name, df in made.items():
        sinks.write_jsonl(df, f"{out}/{name}")
    sinks.write_lines(sinks.living_dot_lines(entities, rel, max_relations, order="relation_id"), f"{out}/living_graph.dot")
    sinks.living_html_rows(entities, rel).orderBy("section", "key").select("html").write.mode("overwrite").text(f"{out}/living_graph.html")
    return made


def export(spark: SparkSession, folder: str, fmt: str, out: str) -> None:
    """A built tree as DOT, JSON lines, GEDCOM or HTML rows."""
    people = content.jsonl(spark, f"{folder}/people", "person_id string, name string, normalized string, birth_year int, death_year int")
    families = content.jsonl(spark, f"{folder}/families", "parent_ids array<string>, child_ids array<string>")
    if fmt == "dot":
        sinks.write_lines(sinks.dot_lines(people, families), out)
    elif fmt == "gedcom":
        sinks.write_lines(sinks.gedcom_lines(people, families), out)
    elif fmt == "html":
        sinks.html_rows(people).orderBy("person_id").select("html").write.mode("overwrite").text(out)
    else:
        sinks.write_jsonl(people, f"{out}/people")
        sinks.write_jsonl(families, f"{out}/families")


def llm_extract(spark: SparkSession, folder: str, out: str, window: int = 1, most: int = 0, completion=None, model: str = "", threads: int = 1) -> dict[str, DataFrame]:
    """The chunks to ask a model about and, with a ``completion``, its answers, the validated claims and their graph.

    Answers are kept in ``journal`` below ``out``: a run that was broken off goes on where it was.
    """
    chunks = content.jsonl(spark, f"{content.artifact_folder(folder, 'source_chunks')}/source_chunks", "source_id string, ordinal int, chunk_id string, text string")
    if completion is None:
        found = {"candidates": LP.prompts(LLM.candidates(chunks, "source_id", "ordinal", window=window, max_candidates=most or None))}
    else:
        found = LP.run(chunks, completion, window=window, max_candidates=most or None, journal=f"{out}/journal", model=model, threads=threads)
        found["rejected"] = found["validated"].where("status = 'rejected'")
    for name, df in found.items():
        sinks.write_jsonl(df, f"{out}/{name}")
    return found


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="heirloom")
    sub = p.add_subparsers(dest="command", required=True)
    b = sub.add_parser("build", help="artifacts from content lists or a living graph")
    b.add_argument("--input", required=True)
    b.add_argument("--output", default="./outputs")
    b.add_argument("--graph-mode", choices=["auto", "tree", "living"], default="auto")
    b.add_argument("--max-relations", type=int, default=400)
    b.add_argument("--include-relation-types", default="", help="of a living graph, types to keep, with commas")
    b.add_argument("--exclude-relation-types", default="", help="of a living graph, types to leave out, with commas")
    b.add_argument("--derive-kinship", action=argparse.BooleanOptionalAction, default=False)
    b.add_argument("--reference-people", default="", help="a JSON array of people whose names and years a tree takes over")
    e = sub.add_parser("export", help="a built tree in another format")
    e.add_argument("--input", required=True)
    e.add_argument("--format", choices=FORMATS, required=True)
    e.add_argument("--output", required=True)
    x = sub.add_parser("llm-extract", help="chunks to ask a model about")
    x.add_argument("--input", required=True)
    x.add_argument("--output", default="", help="default: llm_claim_graph below the input")
    x.add_argument("--context-window", type=int, default=1)
    x.add_argument("--max-candidates", type=int, default=0)
    x.add_argument("--model", default=os.getenv("LLM_MODEL", ""))
    x.add_argument("--llm-base-url", default=os.getenv("LLM_BASE_URL", ""), help="without it, only prompts are written")
    x.add_argument("--llm-api-key", default=os.getenv("LLM_API_KEY", ""))
    x.add_argument("--llm-threads", type=int, default=1, help="questions that a task has open at a time")
    x.add_argument("--llm-timeout", type=int, default=int(os.getenv("LLM_TIMEOUT", "300")))
    x.add_argument("--llm-max-tokens", type=int, default=int(os.getenv("LLM_MAX_TOKENS", "900")))
    return p


def main(argv: list[str] | None = None) -> int:
    a = parser().parse_args(argv)
    spark = SparkSession.builder.getOrCreate()
    if a.command == "build":
        living = a.graph_mode == "living" or a.graph_mode == "auto" and os.path.basename(a.input) == "living_graph.json"
        if living:
            build_living(spark, a.input, a.output, a.max_relations, a.include_relation_types, a.exclude_relation_types, a.derive_kinship)
        else:
            build_tree(spark, a.input, a.output, a.reference_people)
    elif a.command == "export":
        export(spark, a.input, a.format, a.output)
    else:
        ask = LP.http_completion(a.llm_base_url, a.model, a.llm_api_key, a.llm_timeout, a.llm_max_tokens) if a.llm_base_url else None
        llm_extract(spark, a.input, a.output or f"{a.input.rstrip('/')}/llm_claim_graph", a.context_window, a.max_candidates, ask, a.model, a.llm_threads)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
