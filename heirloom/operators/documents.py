"""Text documents about people, relationships and claims, for retrieval."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

COLUMNS = ("document_id", "kind", "text", "person_ids", "claim_ids", "chunk_ids", "rel_key")


def _doc(df: DataFrame, kind: str, key, text, **ids) -> DataFrame:
    none = F.array().cast("array<string>")
    given = {"person_ids": none, "claim_ids": none, "chunk_ids": none, "rel_key": F.lit(None).cast("string")} | ids
    return df.select(F.concat(F.lit(f"{kind}-"), F.md5(key)).alias("document_id"), F.lit(kind).alias("kind"), text.alias("text"), *[c.alias(n) for n, c in given.items()])


def years(birth, death):
    """``(1900-1980)``, with ? for what is missing; empty without either."""
    show = lambda y: F.coalesce(F.nullif(y, F.lit(0)).cast("string"), F.lit("?"))
    return F.when(birth.isNull() & death.isNull(), "").otherwise(F.concat(F.lit(" ("), show(birth), F.lit("-"), show(death), F.lit(")")))


def person_documents(people: DataFrame, rels: DataFrame) -> DataFrame:
    """A document per person naming accepted parents, spouses and children."""
    ok = rels.where("status = 'accepted'")
    edges = (
        ok.where("type = 'parent_of'").select(F.col("tgt").alias("me"), F.lit("Parents").alias("role"), F.col("src").alias("other"))
        .unionByName(ok.where("type = 'parent_of'").select(F.col("src").alias("me"), F.lit("Children").alias("role"), F.col("tgt").alias("other")))
        .unionByName(ok.where("type = 'spouse_of'").select(F.explode(F.array(F.struct(F.col("src").alias("me"), F.col("tgt").alias("other")), F.struct(F.col("tgt").alias("me"), F.col("src").alias("other")))).alias("x")).select("x.me", F.lit("Spouses").alias("role"), "x.other"))
    )
    named = edges.join(people.select(F.col("person_id").alias("other"), F.col("name").alias("other_name")), "other", "left")
    lists = named.groupBy("me", "role").agg(F.concat(F.col("role"), F.lit(": "), F.array_join(F.array_sort(F.collect_set(F.coalesce("other_name", "other"))), ", ")).alias("line"))
    lines = lists.groupBy(F.col("me").alias("person_id")).agg(F.array_join(F.array_sort(F.collect_list("line")), ". ").alias("lines"))
    p = people.join(lines, "person_id", "left")
    text = F.concat(F.lit("Person: "), F.col("name"), years(F.col("birth_year"), F.col("death_year")), F.coalesce(F.concat(F.lit(". "), F.col("lines")), F.lit("")))
    return _doc(p, "person", F.col("person_id"), text, person_ids=F.array("person_id"))


def relationship_documents(rels: DataFrame, people: DataFrame) -> DataFrame:
    """A document per relationship; conflicts say that they are not accepted."""
    name = people.select("person_id", "name")
    r = rels.join(name.select(F.col("person_id").alias("src"), F.col("name").alias("sn")), "src", "left").join(name.select(F.col("person_id").alias("tgt"), F.col("name").alias("tn")), "tgt", "left")
    said = F.concat_ws(" ", F.coalesce("sn", "src"), F.replace("type", F.lit("_"), F.lit(" ")), F.coalesce("tn", "tgt"))
    text = F.when(F.col("status") == "accepted", F.concat(F.lit("Relationship: "), said)).otherwise(F.concat(F.lit("Relationship in conflict, not accepted as fact: "), said))
    key = F.concat_ws("|", "src", "type", "tgt")
    return _doc(r, "relationship", key, text, person_ids=F.array("src", "tgt"), claim_ids=F.col("claim_ids"), rel_key=key)


def claim_documents(claims: DataFrame) -> DataFrame:
    """A document per claim with its quote; ``k`` is the claim's chunk."""
    cid = F.concat_ws("-", F.lit("claim"), "k", "pattern_no", "match_no")
    text = F.concat(F.lit("Claim "), F.col("claim_type"), F.lit(": "), F.col("quote"))
    return _doc(claims, "claim", cid, text, claim_ids=F.array(cid), chunk_ids=F.array(F.col("k").cast("string")))


def chunk_documents(chunks: DataFrame) -> DataFrame:
    return _doc(chunks, "source_chunk", F.col("k").cast("string"), F.col("text"), chunk_ids=F.array(F.col("k").cast("string")))


def family_documents(families: DataFrame, people: DataFrame) -> DataFrame:
    """A document per family with the names of parents and children."""
    f = families.withColumn("fid", F.concat(F.lit("family-"), F.md5(F.array_join("parent_ids", ","))))
    member = f.select("fid", F.explode("parent_ids").alias("person_id"), F.lit("p").alias("role")).unionByName(f.select("fid", F.explode("child_ids").alias("person_id"), F.lit("c").alias("role")))
    named = member.join(people.select("person_id", "name"), "person_id", "left").withColumn("name", F.coalesce("name", "person_id"))
    of = lambda r: F.array_join(F.array_sort(F.collect_set(F.when(F.col("role") == r, F.col("name")))), ", ")
    lists = named.groupBy("fid").agg(of("p").alias("parents"), of("c").alias("children"), F.sort_array(F.collect_set("person_id")).alias("ids"))
    text = F.concat(F.lit("Family. Parents: "), F.col("parents"), F.when(F.col("children") != "", F.concat(F.lit(". Children: "), F.col("children"))).otherwise(""))
    return _doc(lists, "family", F.col("fid"), text, person_ids=F.col("ids"))


def conflict_documents(conflicts: DataFrame) -> DataFrame:
    """A document per row of ``people.conflicts``."""
    text = F.concat(F.lit("Conflict "), F.replace("conflict_type", F.lit("_"), F.lit(" ")), F.lit(": "), F.array_join("person_ids", ", "))
    return _doc(conflicts, "conflict", F.concat_ws("|", F.col("conflict_type"), F.col("key")), text, person_ids=F.col("person_ids"), claim_ids=F.col("claim_ids"))


def mention_documents(mentions: DataFrame) -> DataFrame:
    """A document per mention, ``k, mention_no, surface, birth_year, death_year``."""
    text = F.concat(F.lit("Mention: "), F.col("surface"), years(F.col("birth_year"), F.col("death_year")))
    return _doc(mentions, "mention", F.concat_ws("|", F.col("k").cast("string"), F.col("mention_no").cast("string")), text, chunk_ids=F.array(F.col("k").cast("string")))


def resolution_text() -> Column:
    """The text about a mention with ``surface, outcome, candidates``."""
    return F.concat(F.lit("Resolution of "), F.col("surface"), F.lit(": "), F.replace("outcome", F.lit("_"), F.lit(" ")), F.when(F.size("candidates") > 0, F.concat(F.lit(". Candidates: "), F.array_join("candidates", ", "))).otherwise(""))


def resolution_documents(resolved: DataFrame, key: str = "mention_id") -> DataFrame:
    """A document per resolved or unresolved mention (rows of ``people.resolve_mentions``, which may have a ``text`` made before)."""
    if "text" in resolved.columns:
        ids = F.col("candidates") if "candidates" in resolved.columns else F.array().cast("array<string>")
        return _doc(resolved, "resolution", F.col(key).cast("string"), F.col("text"), person_ids=ids)
    return _doc(resolved, "resolution", F.col(key).cast("string"), resolution_text(), person_ids=F.col("candidates"))
