"""From a model's answers to validated claims and the graph that they make."""

from __future__ import annotations

import json
import urllib.request
from collections.abc import Callable
from urllib.parse import urlsplit

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from heirloom.cut import cut
from heirloom.functions import text as T
from heirloom.operators import claims as C
from heirloom.operators import journal as J
from heirloom.operators import llm_claims as LLM
from heirloom.operators import people as P
from heirloom.sources import content

#: How a model is asked; the fields of an answer that `claims` reads.
ASK = """Find statements of kinship in the passage below, Russian or English, and answer with JSON alone.
Take names as they are written. Where a pronoun stands for the subject named here, use the subject.
Say nothing that the passage does not say; without any statement answer {"claims": []}.
Each claim has "claim_type" ("parent_child" with "child" and "parents", or "spouse" with "person1" and "person2"),
"evidence_quote" (a short part of the passage, word for word), "confidence" (0 to 1) and "notes".
A person is {"name": ..., "birth_year": ..., "death_year": ...}. /no_think
"""


def context_text() -> Column:
    """A candidate with its neighbours."""
    part = lambda title, c: F.when(F.coalesce(F.col(c), F.lit("")) != "", F.concat(F.lit(title + ":\n"), F.col(c)))
    return F.concat_ws("\n\n", part("PREVIOUS", "previous_text"), part("CURRENT", "text"), part("NEXT", "next_text"))


def prompts(candidates: DataFrame) -> DataFrame:
    """Add ``candidate_id``, ``context`` and ``prompt`` to candidate chunks."""
    cid = T.stable_id("llm-candidate", F.col("source_id"), F.col("chunk_id"), F.col("text"))
    d = candidates.withColumns({"candidate_id": cid, "context": context_text()})
    about = F.concat_ws("\n", F.concat(F.lit("Subject: "), F.coalesce("subject_hint", F.lit("unknown"))), F.concat(F.lit("Cues: "), F.array_join("trigger_terms", ", ")))
    return d.withColumn("prompt", F.concat_ws("\n", F.lit(ASK), about, F.lit(""), F.col("context")))


def http_completion(url: str, model: str, key: str = "", timeout: int = 300, max_tokens: int = 900) -> Callable[[str], str]:
    """A completion function that asks a chat endpoint, for ``llm_claims.complete``."""

    if content.offline() and urlsplit(url).hostname not in ("localhost", "127.0.0.1", "::1"):
        raise PermissionError("the environment forbids network access")

    def ask(prompt: str) -> str:
        body = {"model": model, "temperature": 0, "max_tokens": max_tokens, "messages": [{"role": "user", "content": prompt}]}
        head = {"Content-Type": "application/json"} | ({"Authorization": f"Bearer {key}"} if key else {})
        request = urllib.request.Request(url.rstrip("/") + "/chat/completions", json.dumps(body).encode(), head)
        with urllib.request.urlopen(request, timeout=timeout) as answer:
            return json.load(answer)["choices"][0]["message"]["content"]

    return ask


def _get(v: Column, path: str, kind: str = "variant") -> Column:
    return F.try_variant_get(v, path, kind)


def _first(v: Column, *names: str) -> Column:
    """The first field that holds something: no null, empty or zero value."""
    empty = ["null", '""', "{}", "[]", "0", "0.0", "false"]
    return F.coalesce(*[F.when(~F.to_json(_get(v, f"$.{n}")).isin(empty), _get(v, f"$.{n}")) for n in names])


def _is(v: Column, kind: str) -> Column:
    return F.coalesce(F.schema_of_variant(v).startswith(kind), F.lit(False))


def _list(v: Column) -> Column:
    """The members of a variant array; empty for anything else."""
    return F.coalesce(F.when(_is(v, "ARRAY"), _get(v, "$", "array<variant>")), F.array().cast("array<variant>"))


def _person(v: Column) -> Column:
    """``name, birth_year, death_year`` of an object, or of a bare name."""
    year = lambda n: F.when(_is(v, "OBJECT"), T.strict_year(_get(v, f"$.{n}", "string")))
    name = F.when(_is(v, "OBJECT"), _get(v, "$.name", "string")).otherwise(_get(v, "$", "string"))
    return F.struct(F.trim(F.coalesce(name, F.lit(""))).alias("name"), year("birth_year").alias("birth"), year("death_year").alias("death"))


#: Other words for the supported types.
SAME_TYPE = {"parent": "parent_child", "parents": "parent_child", "parent_child_relation": "parent_child", "marriage": "spouse", "married": "spouse", "spouses": "spouse"}


def claims(parsed: DataFrame, column: str = "parsed") -> DataFrame:
    """One row per claim of a parsed answer: adds ``claim_no, child_no, raw_claim, claim_type, first, others, evidence_quote, confidence``.

    An answer is an object with ``claims`` or an array; members that are no objects
    are left out, and so are answers without any.  A ``child_list`` makes a row per
    child.  ``first`` and the members of ``others`` are people: name and years.
    """
    v = F.try_parse_json(F.col(column))
    found = F.filter(_list(F.when(_is(v, "OBJECT"), _first(v, "claims")).otherwise(v)), lambda x: _is(x, "OBJECT"))
    rows = parsed.withColumn("_found", found).select(*parsed.columns, F.posexplode("_found").alias("claim_no", "_c"))
    c = F.col("_c")
    said = F.replace(F.lower(F.trim(F.coalesce(_first(c, "claim_type", "type").cast("string"), F.lit("")))), F.lit("-"), F.lit("_"))
    kind = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in SAME_TYPE.items() for x in kv]), said), said)
    rows = rows.withColumn("claim_type", kind)
    each = F.when(F.col("claim_type") == "child_list", _list(_get(c, "$.children"))).otherwise(F.array(_first(c, "child", "person")))
    rows = rows.withColumn("_each", each).select(*[x for x in rows.columns], F.posexplode("_each").alias("child_no", "_child"))
    rows = rows.withColumn("claim_type", F.when(F.col("claim_type") == "child_list", "parent_child").otherwise(F.col("claim_type")))
    parents = _first(c, "parents", "parent")
    parents = F.when(_is(parents, "OBJECT"), F.array(parents)).otherwise(_list(parents))
    kind = F.col("claim_type")
    first = F.when(kind == "spouse", _person(_first(c, "person1", "spouse1"))).when(kind == "parent_child", _person(F.col("_child"))).otherwise(_person(_first(c, "person", "subject")))
    named = F.filter(F.transform(parents, _person), lambda x: x["name"] != "")
    others = F.when(kind == "spouse", F.array(_person(_first(c, "person2", "spouse2")))).when(kind == "parent_child", named)

    def told(name: str) -> Column:
        f = _get(c, f"$.{name}")
        return F.nullif(F.trim(F.when(_is(f, "OBJECT"), _get(f, "$.quote", "string")).when(_is(f, "STRING"), _get(f, "$", "string"))), F.lit(""))

    rows = rows.withColumns({
        "first": first, "others": others, "evidence_quote": F.coalesce(told("evidence_quote"), told("quote"), told("evidence")),
        "confidence": T.confidence(_get(c, "$.confidence", "string")), "raw_claim": F.to_json(c),
    })
    return rows.drop("_c", "_each", "_child")


def validate(raw: DataFrame, candidates: DataFrame) -> DataFrame:
    """One row per claim of each answer, or per answer without one, with ``status`` and ``reason``.

    ``raw`` has ``candidate_id, parsed, parse_status``, ``candidates`` has
    ``candidate_id, context``.  Status is accepted_candidate, rejected, or empty
    for an answer that states nothing.
    """
    known = raw.join(candidates.select("candidate_id", "context"), "candidate_id", "left")
    readable = F.col("context").isNotNull() & F.col("parsed").isNotNull()
    made = claims(known.where(readable))
    judged = LLM.judge(made.withColumns({"person1": F.col("first.name"), "_people": F.col("others"), "others": F.col("others.name")}))
    judged = judged.withColumn("others", F.col("_people")).drop("person1", "_people")
    empty = ["candidate_id"]
    without = known.where(readable).join(_payload_sizes(known.where(readable)).where("n = 0").select(*empty), empty, "left_semi")
    lost = known.where(~readable)
    blank = lambda df, status, reason: df.withColumns({"status": F.lit(status), "reason": reason})
    every = judged.unionByName(blank(without, "empty", F.lit(None).cast("string")), allowMissingColumns=True)
    return every.unionByName(blank(lost, "rejected", F.when(F.col("context").isNull(), "missing_candidate").otherwise(F.col("parse_status"))), allowMissingColumns=True)


def _payload_sizes(parsed: DataFrame) -> DataFrame:
    v = F.try_parse_json(F.col("parsed"))
    found = F.filter(_list(F.when(_is(v, "OBJECT"), _first(v, "claims")).otherwise(v)), lambda x: _is(x, "OBJECT"))
    return parsed.select("candidate_id", F.size(found).alias("n"))


def accepted_claims(validated: DataFrame) -> DataFrame:
    """Accepted parent and spouse claims as ``claims.extract_claims`` gives them, at most two parents each."""
    d = validated.where((F.col("status") == "accepted_candidate") & F.col("claim_type").isin("parent_child", "spouse"))
    person = lambda i: F.col("first") if i == 1 else F.get("others", F.lit(i - 2))
    cols = [x for i in (1, 2, 3) for x in (person(i)["name"].alias(f"name{i}"), person(i)["birth"].alias(f"birth{i}"), person(i)["death"].alias(f"death{i}"))]
    return d.select(F.col("candidate_id").alias("k"), F.col("claim_no").alias("pattern_no"), F.col("child_no").alias("match_no"), "claim_type", F.col("evidence_quote").alias("quote"), *cols, "confidence")


def graph(claims: DataFrame) -> dict[str, DataFrame]:
    """People, relationships, families and conflicts of claims."""
    claims = cut(claims)
    roles = C.claim_people(claims)
    people = cut(P.fold_people(roles))
    rels = cut(P.validate(P.relationships(claims, roles, people), people))
    return {"claims": claims, "people": people, "relationships": rels, "families": P.families(rels, "accepted"), "conflicts": P.conflicts(rels, roles, people)}


def run(chunks: DataFrame, completion: Callable[[str], str], group: str = "source_id", position: str = "ordinal", window: int = 1, max_candidates: int | None = None, journal: str = "", model: str = "", threads: int = 1) -> dict[str, DataFrame]:
    """From chunks to a graph: candidates, prompts, answers, validated claims, people and relationships.

    Answers are written to the shared folder before they are read again, so that no
    row is asked twice.  With ``journal``, a folder, answers of earlier runs count too: see ``journal.ask``.
    """
    found = cut(prompts(LLM.candidates(chunks, group, position, window=window, max_candidates=max_candidates)))
    wanted = found.select("candidate_id", "chunk_id", "prompt")
    raw = cut(J.ask(wanted, completion, journal, model, threads=threads) if journal else LLM.complete(wanted, completion, threads=threads))
    validated = cut(validate(raw, found))
    return {"candidates": found, "raw": raw, "validated": validated, **graph(accepted_claims(validated))}

