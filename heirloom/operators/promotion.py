"""Relations made stronger by what their quotes say: parents, aunts and uncles.

Both rules take relations ``src, tgt, type, confidence, quote`` (more columns
pass through) and entities ``entity_id, canonical_name, gender, birth_year``.
They add ``promoted``.  Relations with a null or unknown end, or without a quote,
stay as they are.  One equi-join per end; all else is columns of the row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from heirloom.functions import names as N
from heirloom.functions import text as T
from heirloom.functions import vocab as V

_WORK = ["_s", "_t", "_cue"]


def _ready(rel: DataFrame, entities: DataFrame) -> DataFrame:
    """``_s`` and ``_t``: name, birth year and gender of the ends; ``_cue``: the quote for cue search."""
    e = entities.select("entity_id", F.struct(F.coalesce("canonical_name", "entity_id").alias("name"), T.strict_year(F.col("birth_year")).alias("born"), T.gender(F.col("gender")).alias("g")).alias("who"))
    r = rel.join(e.toDF("src", "_s"), "src", "left").join(e.toDF("tgt", "_t"), "tgt", "left")
    return r.withColumn("_cue", T.cue_text(F.col("quote")))


def _both() -> Column:
    return F.col("_s").isNotNull() & F.col("_t").isNotNull() & (F.col("src") != F.col("tgt")) & (F.col("_cue") != "")


def _older(a: str, b: str) -> Column:
    return F.coalesce(F.col(f"{a}.born") <= F.col(f"{b}.born") - V.PARENT_GAP[0], F.lit(False))


def _turned(rel: DataFrame, r: DataFrame, turn: Column, new_type: Column) -> DataFrame:
    """Columns of ``rel`` with promoted rows retyped, and turned around where ``turn``."""
    p, t = F.col("promoted"), F.col("promoted") & F.coalesce(turn, F.lit(False))
    new = {"src": F.when(t, F.col("tgt")).otherwise(F.col("src")), "tgt": F.when(t, F.col("src")).otherwise(F.col("tgt")), "type": F.when(p, new_type).otherwise(F.col("type"))}
    if "directed" in rel.columns:
        new["directed"] = p | F.col("directed")
    if "symmetric" in rel.columns:
        new["symmetric"] = ~p & F.col("symmetric")
    return r.select(*[new[c].alias(c) if c in new else F.col(c) for c in rel.columns if c != "promoted"], "promoted")


def promote_parents(rel: DataFrame, entities: DataFrame) -> DataFrame:
    """Weak relations become ``parent_child`` where quote, years and patronymics say who the parent is.

    Each end gets a vote for standing after a child cue, for standing before a
    cue of bearing or having, for being 12 years older, and for the other's
    patronymic.  The one with more votes is the parent; beside words for
    collateral kin it takes two votes more.  Without an explicit cue the
    patronymic alone decides.
    """
    r = _ready(rel, entities)
    cue, sn, tn = F.col("_cue"), F.col("_s.name"), F.col("_t.name")
    r = r.withColumns({
        "_sp": N.patronymic_parent(sn, tn), "_tp": N.patronymic_parent(tn, sn), "_sa": N.name_place(sn, cue), "_ta": N.name_place(tn, cue),
        "_after": N.cue_place(cue, V.PARENT_BEFORE), "_before": N.cue_place(cue, V.PARENT_AFTER), "_told": N.has_cue(cue, V.PARENT_CUES),
    })
    vote = lambda c: F.when(c, 1).otherwise(0)

    def votes(me: str, other: str) -> Column:
        at = F.col(f"{me}a")
        return vote(at > F.col("_after")) + vote(at < F.col("_before")) + vote(_older(me, other)) + vote(F.col(f"{me}p"))

    named = F.col("_sa").isNotNull() | F.col("_ta").isNotNull() | F.col("_sp") | F.col("_tp")
    lead = F.when(F.col("_told"), F.when(named, votes("_s", "_t") - votes("_t", "_s"))).otherwise(vote(F.col("_sp")) - vote(F.col("_tp")))
    least = F.when(F.col("_told") & N.has_cue(cue, V.COLLATERAL_CUES), 2).otherwise(1)
    weak = F.lower(T.relation_type(F.col("type"))).isin(V.WEAK_TYPES) & (F.coalesce("confidence", F.lit(0.0)) >= V.PROMOTION_CONFIDENCE)
    hinted = N.has_cue(cue, V.PARENT_HINTS) | F.col("_sp") | F.col("_tp")
    ok = weak & _both() & ~N.has_cue(cue, V.SPOUSE_CUES) & hinted & (F.abs("_lead") >= least)
    r = r.withColumn("_lead", lead).withColumn("promoted", F.coalesce(ok, F.lit(False)))
    return _turned(rel, r, F.col("_lead") < 0, F.lit("parent_child"))


def promote_avuncular(rel: DataFrame, entities: DataFrame) -> DataFrame:
    """Relations whose quote speaks of a niece or nephew become ``uncle_of``, ``aunt_of`` or ``aunt_uncle_of``.

    A parent relation whose quote names its source as the parent stays.  The aunt
    or uncle is the one named alone after the cue, else the one 12 years older.
    """
    r = _ready(rel, entities)
    cue, sn, tn = F.col("_cue"), F.col("_s.name"), F.col("_t.name")
    marked = F.coalesce(_both() & cue.rlike("|".join(V.NIBLING_MARKS)), F.lit(False))
    parent = F.lower(T.relation_type(F.col("type"))).isin(V.PARENT_TYPES)
    r = r.withColumns({"_marked": marked, "_at": N.cue_place(cue, V.NIBLING_CUES), "_sa": N.name_place(sn, cue), "_ta": N.name_place(tn, cue)})
    r = r.withColumn("_anchor", N.parent_anchor(cue, sn, tn, F.col("_marked") & parent))

    def alone_after(me: str, other: str) -> Column:
        return (F.col(me) > F.col("_at")) & F.coalesce(F.col(other) < F.col("_at"), F.lit(True))

    source = F.when(alone_after("_sa", "_ta"), True).when(alone_after("_ta", "_sa"), False).when(_older("_s", "_t"), True).when(_older("_t", "_s"), False)
    r = r.withColumn("_source", source).withColumn("promoted", F.col("_marked") & F.col("_source").isNotNull() & ~(parent & (F.col("_anchor") >= 1)))
    g = F.when(F.col("_source"), F.col("_s.g")).otherwise(F.col("_t.g"))
    return _turned(rel, r, ~F.col("_source"), T.gendered("uncle_of", "aunt_of", "aunt_uncle_of", g))
