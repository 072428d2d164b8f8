"""Lexical and graph-ranked retrieval over text documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from heirloom.cut import cut, few
from heirloom.functions import text as T
from heirloom.operators import variants


def lexical_scores(docs: DataFrame, query: str, text: str = "text", kind: str | None = None) -> DataFrame:
    """Add ``score``: share of query tokens found, 0.05 for each of up to five occurrences, 0.1 for people and claims.

    Documents without a token of the query are left out.
    """
    q = F.array_distinct(T.tokens(F.lit(query)))
    d = docs.withColumn("_t", T.tokens(F.col(text)))
    d = d.withColumn("_o", F.array_intersect(q, "_t")).where(F.size("_o") > 0)
    times = F.size(F.filter("_t", lambda t: F.array_contains(F.col("_o"), t)))
    score = F.size("_o") / F.greatest(F.size(q), F.lit(1)) + F.lit(0.05) * F.least(times, F.lit(5))
    if kind:
        score = score + F.when(F.col(kind).isin("person", "claim"), 0.1).otherwise(0.0)
    return d.withColumn("score", score).drop("_t", "_o")


def top(scored: DataFrame, k: int = 8, key: str = "document_id") -> DataFrame:
    """The best ``k``: by score, people and claims first, then by id, all descending; one TakeOrdered."""
    first = F.col("kind").isin("person", "claim") if "kind" in scored.columns else F.lit(False)
    return scored.orderBy(F.desc("score"), first.desc(), F.desc(key)).limit(max(0, k))


def resolve_query(people: DataFrame, query: str, surfaces: DataFrame | None = None) -> DataFrame:
    """Whom the query names by any form (``variants.forms``): most words, then the last form, then the smallest id; one row or none.

    One scan of the forms; for many questions see ``variants.resolve_questions``.
    """
    named = variants.spellings(people, surfaces, ("name", "normalized")).where(T.contains_phrase(T.normalize_name(F.lit(query)), F.col("variant")))
    n = F.size(F.split("variant", " "))
    score = F.lit(0.7) + F.least(F.lit(0.25), F.lit(0.04) * n)
    found = named.select("person_id", "name", "normalized", F.col("variant").alias("matched_text"), score.alias("confidence"), T.intent(F.lit(query)).alias("intent"), n.alias("_n"))
    return found.orderBy(F.desc("confidence"), F.desc("_n"), F.desc("matched_text"), "person_id").limit(1).drop("_n")


def relations_for(rels: DataFrame, person: DataFrame) -> DataFrame:
    """Accepted relationships that answer the intent of a resolved query (one row of ``resolve_query``)."""
    q = F.broadcast(person.select("person_id", "intent"))  # one row
    r = rels.where(F.lower("status") == "accepted")
    at_src, at_tgt = F.col("src") == F.col("person_id"), F.col("tgt") == F.col("person_id")
    parent, spouse = F.col("type") == "parent_of", F.col("type") == "spouse_of"
    wanted = F.when(F.col("intent") == "parents", parent & at_tgt).when(F.col("intent") == "children", parent & at_src).when(F.col("intent") == "spouses", spouse).otherwise(F.lit(True))
    return r.join(q, at_src | at_tgt).where(wanted).select(*rels.columns)


def graph_ranked(docs: DataFrame, rels: DataFrame, person: DataFrame) -> DataFrame:
    """Documents near the asked person with fixed scores: ``docs.columns, score``; the earliest pass wins.

    ``docs`` has ``document_id, kind, person_ids, claim_ids, chunk_ids, rel_key``.
    """
    chosen = cut(relations_for(rels, person))
    me = person.select("person_id")
    # Documents stay where they are if the ids that they are asked for are few.
    near = few(chosen.select(F.explode(F.array("src", "tgt")).alias("person_id")).distinct().join(me, "person_id", "left_anti"))
    claims = few(chosen.select(F.explode("claim_ids").alias("claim_id")).distinct())
    me = few(me)
    of = lambda kind, column, name: docs.where(F.col("kind") == kind).withColumn(name, F.explode(column))
    keep = lambda df, score, no: df.select(*docs.columns, F.lit(score).alias("score"), F.lit(no).alias("_no"))
    claim_docs = of("claim", "claim_ids", "claim_id").join(claims, "claim_id", "left_semi")
    chunks = few(claim_docs.select(F.explode("chunk_ids").alias("chunk_id")).distinct())
    rel_keys = few(chosen.select(F.concat_ws("|", "src", "type", "tgt").alias("rel_key")))
    found = (
        keep(of("person", "person_ids", "person_id").join(me, "person_id", "left_semi"), 5.0, 0)
        .unionByName(keep(docs.where("kind = 'relationship'").join(rel_keys, "rel_key", "left_semi"), 4.5, 1))
        .unionByName(keep(of("person", "person_ids", "person_id").join(near, "person_id", "left_semi"), 3.5, 2))
        .unionByName(keep(claim_docs, 3.0, 3))
        .unionByName(keep(of("resolution", "person_ids", "person_id").join(me, "person_id", "left_semi"), 2.2, 4))
        .unionByName(keep(of("source_chunk", "chunk_ids", "chunk_id").join(chunks, "chunk_id", "left_semi"), 2.5, 5))
    )
    first = F.row_number().over(Window.partitionBy("kind", "document_id").orderBy("_no"))
    return found.withColumn("_r", first).where("_r = 1").drop("_r", "_no")
