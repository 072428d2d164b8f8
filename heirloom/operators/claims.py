"""Kinship claims and person mentions from text, with native regular expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from heirloom.functions import text as T
from heirloom.functions import vocab as V


def _matches(no: int, kind: str, pattern: str, cue: str) -> Column:
    """The matches of one pattern in ``_t`` with its groups.

    Only a text with a cue word is searched, once; the groups are taken from the
    short matches, where the pattern takes the same way as in the text.
    """
    whole = F.when(F.col("_t").rlike(cue), F.regexp_extract_all("_t", F.lit(pattern), F.lit(0)))
    return F.transform(
        F.coalesce(whole, F.array().cast("array<string>")),
        lambda m, i: F.struct(
            F.lit(no).alias("pattern_no"), i.alias("match_no"), F.lit(kind).alias("claim_type"), m.alias("quote"), *[F.regexp_extract(m, pattern, g).alias(f"r{g}") for g in (1, 2, 3)]
        ),
    )


def extract_claims(df: DataFrame, text: str = "text", keys: tuple[str, ...] = ("k",)) -> DataFrame:
    """One row per claim: ``keys, pattern_no, match_no, claim_type, confidence, quote`` and up to three people.

    ``name1`` is the child or first spouse, ``name2`` and ``name3`` the parents or
    the second spouse; ``birth1, death1, ...`` their years.  A claim without a
    first or second name is dropped.  The text is compacted first; matches of one
    pattern do not overlap.
    """
    base = df.select(*keys, T.compact(F.col(text)).alias("_t"))
    # All patterns read the text in one pass.
    found = F.array(*[_matches(no, kind, p, V.CLAIM_CUES[no]) for no, (kind, p) in enumerate(V.JAVA_CLAIMS)])
    rows = base.select(*keys, F.inline(F.flatten(found)))
    for i in (1, 2, 3):
        raw = F.nullif(F.col(f"r{i}"), F.lit(""))
        low, high = T.year_range(raw)
        rows = rows.withColumns({f"name{i}": F.nullif(T.clean_name(raw), F.lit("")), f"birth{i}": low, f"death{i}": high})
    confidence = F.when(F.col("claim_type") == "spouse", V.CONFIDENCE["spouse"]).otherwise(V.CONFIDENCE["parent_child"])
    return rows.drop("r1", "r2", "r3").where("name1 is not null and name2 is not null").withColumn("confidence", confidence)


def claim_people(claims: DataFrame, keys: tuple[str, ...] = ("k",)) -> DataFrame:
    """The people of claims in their order: ``keys, pattern_no, match_no, role, name, normalized, birth_year, death_year``."""
    one = F.array(*[F.struct(F.lit(i).alias("role"), F.col(f"name{i}").alias("name"), F.col(f"birth{i}").alias("birth_year"), F.col(f"death{i}").alias("death_year")) for i in (1, 2, 3)])
    rows = claims.select(*keys, "pattern_no", "match_no", "claim_type", F.inline(one)).where("name is not null")
    return rows.withColumn("normalized", T.normalize_name(F.col("name"))).where("normalized <> ''")


def extract_mentions(df: DataFrame, text: str = "text", keys: tuple[str, ...] = ("k",)) -> DataFrame:
    """Capitalised names of up to four words: ``keys, mention_no, raw, surface, normalized, birth_year, death_year, span_start, span_end``.

    Spans are code points of the raw text; they follow from the lengths of the
    pieces that a split at the matches leaves.
    """
    pattern = V.MENTION + V.YEARS_SUFFIX
    base = df.select(*keys, F.col(text).alias("_t"))
    base = base.withColumns({"_m": F.regexp_extract_all("_t", F.lit(f"({pattern})"), F.lit(1)), "_s": F.split("_t", pattern, -1)})
    # The start of a match: what the split leaves up to it and the matches before, summed once along the text.
    steps = F.zip_with(F.transform("_m", lambda x: F.length(x)), F.transform("_s", lambda x: F.length(x)), lambda m, s: F.struct(s.alias("s"), F.coalesce(m, F.lit(0)).alias("m")))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("all"))
    walk = F.aggregate(steps, start, lambda a, x: F.struct((a["at"] + x["s"] + x["m"]).alias("at"), F.concat(a["all"], F.array(a["at"] + x["s"])).alias("all")))
    rows = base.withColumn("_at", walk["all"]).select(*keys, "_at", F.posexplode("_m").alias("mention_no", "raw"))
    start = F.get("_at", F.col("mention_no"))
    low, high = T.year_range(F.col("raw"))
    rows = rows.withColumns({"surface": T.clean_name(F.col("raw")), "birth_year": low, "death_year": high, "span_start": start, "span_end": start + F.length("raw")})
    rows = rows.withColumn("normalized", T.normalize_name(F.col("surface"))).drop("_at")
    noise = F.col("normalized").isin(V.MENTION_NOISE)
    return rows.where(~noise & ~F.col("normalized").rlike(r"^[\d ]+$") & F.col("surface").rlike(r"\p{L}"))


def trigger_terms(x: Column) -> Column:
    """The kinship words of a text, sorted."""
    return F.array_sort(F.array_intersect(F.array_distinct(T.tokens(x)), F.array(*[F.lit(t) for t in V.TRIGGERS])))


def subject_hint(x: Column) -> Column:
    """The name that a heading is about."""
    c = T.compact(F.coalesce(x, F.lit("")))
    return reduce(lambda a, b: F.coalesce(a, b), [F.nullif(F.regexp_replace(F.regexp_extract(c, p, 1), r"^[ .,:;-]+|[ .,:;-]+$", ""), F.lit("")) for p in V.HEADINGS])
