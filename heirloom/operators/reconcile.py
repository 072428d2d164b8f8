"""People matched one to one with reference people by name, and enriched from them."""

from __future__ import annotations

import math
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from heirloom.cut import cut
from heirloom.functions import text as T
from heirloom.operators.components import connected_components

# Weights of the letters' and the tokens' likeness, the bonus, and the bounds of a match.
LETTERS, TOKENS, BONUS, MATCH, GAP = 0.65, 0.35, 0.08, 0.86, 0.04
#: The least share of common tokens with which a match is possible.
LEAST_SHARE = (MATCH - LETTERS - BONUS) / TOKENS
FIELDS = ("birth_year", "death_year", "birth_place", "death_place")


def name_score(a: str, b: str) -> float:
    """Likeness of two normalized names, 0 to 1."""
    if not a or not b:
        return 0.0
    x, y = set(a.split()), set(b.split())
    common = x & y
    bonus = BONUS if len(common) > 1 and common in (x, y) else 0.0
    return 1.0 if a == b else min(1.0, LETTERS * SequenceMatcher(None, a, b).ratio() + TOKENS * len(common) / len(x | y) + bonus)


@F.pandas_udf(DoubleType())
def score(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([name_score(x, y) for x, y in zip(a, b, strict=True)], dtype="float64")


def _variants(df: DataFrame, key: str) -> DataFrame:
    """``key, variant, toks``: the normalized name and the given normalized form."""
    given = F.trim("normalized_name") if "normalized_name" in df.columns else F.lit(None).cast("string")
    named = T.normalize_name(F.col("name"))
    v = df.select(key, F.explode(F.array_distinct(F.array(named, F.coalesce(given, named)))).alias("variant")).where("variant <> ''")
    return v.withColumn("toks", F.array_distinct(F.split("variant", r"(?U)\s+")))


def _needed(n: Column) -> Column:
    """Tokens that a match has in common with a name of ``n``: one alone means equal names, from two on at least two."""
    return F.when(n == 1, 1).otherwise(F.greatest(F.lit(2), F.ceil(n * (math.floor(LEAST_SHARE * 1e6) / 1e6))))


def candidates(people: DataFrame, reference: DataFrame) -> DataFrame:
    """``seq, ref, score`` of all pairs at the match bound or above.

    Pairs that share none of their rarest tokens cannot reach it, so names meet on
    these prefixes only: a family name that a third of all people bear is no key.
    """
    p, r = _variants(people, "seq"), _variants(reference, "ref")
    v = p.select("variant", "toks").union(r.select("variant", "toks")).distinct()
    often = v.select(F.explode("toks").alias("tok")).groupBy("tok").agg(F.count(F.lit(1)).alias("n"))
    ranked = v.select("variant", F.explode("toks").alias("tok")).join(often, "tok").groupBy("variant").agg(F.sort_array(F.collect_list(F.struct("n", "tok")))["tok"].alias("toks"))
    n = F.size("toks")
    keys = cut(ranked.select("variant", F.explode(F.slice("toks", F.lit(1), F.greatest(F.lit(1), (n - _needed(n) + 1).cast("int")))).alias("key")))
    left, right = keys.join(p.select("variant").distinct(), "variant", "left_semi"), keys.join(r.select("variant").distinct(), "variant", "left_semi")
    like = left.join(right.withColumnRenamed("variant", "other"), "key").select("variant", "other").distinct()
    like = cut(like.withColumn("score", score("variant", "other")).where(F.col("score") >= MATCH))
    pairs = like.join(p.select("seq", "variant"), "variant").join(r.select("ref", F.col("variant").alias("other")), "other")
    return pairs.groupBy("seq", "ref").agg(F.max("score").alias("score"))


def _greedy(pdf: pd.DataFrame) -> pd.DataFrame:
    """In order of people, the best reference that is free, unless the next best is nearly as good."""
    free: set[int] = set(pdf["ref"])
    out = []
    for seq, g in pdf.sort_values(["seq", "score", "ref"], ascending=[True, False, True]).groupby("seq", sort=False):
        open_ = [(r, s) for r, s in zip(g["ref"], g["score"], strict=True) if r in free]
        if open_ and (len(open_) == 1 or open_[0][1] - open_[1][1] >= GAP):
            free.remove(open_[0][0])
            out.append((seq, *open_[0]))
    return pd.DataFrame(out, columns=["seq", "ref", "score"])


def match(people: DataFrame, reference: DataFrame) -> DataFrame:
    """``seq, ref, score``: at most one reference per person and one person per reference.

    References are taken in the order of ``seq``.  People that share no candidate,
    even through others, do not compete, so each connected group is settled alone.
    """
    c = cut(candidates(people, reference))
    node = lambda kind, col: F.concat(F.lit(kind), F.lpad(F.col(col).cast("string"), 20, "0"))
    e = c.select(node("p", "seq").alias("src"), node("r", "ref").alias("dst"))
    comp = connected_components(e)
    grouped = c.withColumn("id", node("p", "seq")).join(comp, "id")
    return grouped.select("component", "seq", "ref", "score").groupBy("component").applyInPandas(lambda g: _greedy(g[["seq", "ref", "score"]]), "seq long, ref long, score double")


def reconcile(people: DataFrame, reference: DataFrame) -> DataFrame:
    """Matched people take the reference's name (theirs becomes an alias), normalized name, missing years and places, and aliases.

    ``people`` has ``seq``, ``reference`` has ``ref``: whole numbers that give the
    order.  Adds ``ref``, null where unmatched.  Blank names match nothing.
    """
    none = F.array().cast("array<string>")
    r = reference.select("ref", F.struct(*[c for c in reference.columns if c != "ref"]).alias("_r"))
    j = people.join(match(people, reference).select("seq", "ref"), "seq", "left").join(r, "ref", "left")
    hit = F.col("_r").isNotNull()
    new, old = F.trim("_r.name"), F.col("name")
    renamed = hit & F.coalesce(new != old, F.lit(True))
    mine = F.coalesce("aliases", none) if "aliases" in people.columns else none
    theirs = F.coalesce("_r.aliases", none) if "aliases" in reference.columns else none
    more = F.concat(F.when(renamed & (F.trim(old) != ""), F.array(F.trim(old))).otherwise(none), F.when(hit, F.filter(F.transform(theirs, lambda x: F.trim(x)), lambda x: x != "")).otherwise(none))
    norm = F.coalesce(F.nullif(F.trim("_r.normalized_name"), F.lit("")), T.normalize_name(new)) if "normalized_name" in reference.columns else T.normalize_name(new)
    cols = {"name": F.when(hit, new).otherwise(old), "aliases": F.concat(mine, F.array_except(more, mine))}
    if "normalized_name" in people.columns:
        cols["normalized_name"] = F.when(hit, norm).otherwise(F.col("normalized_name"))
    for c in FIELDS:
        if c in people.columns and c in reference.columns:
            blank = F.lit("") if c.endswith("place") else F.lit(0)
            cols[c] = F.coalesce(F.nullif(F.col(c), blank), F.nullif(F.col(f"_r.{c}"), blank), F.col(c))
    keep = [c for c in people.columns if c not in cols]
    return j.select(*keep, *[v.alias(k) for k, v in cols.items()], "ref")
