"""Entities that are one person under several names, merged.

Comparing all pairs is not needed.  Entities with the same type, gender, years
and name form one profile; profiles meet through equal names, through names that
begin with the other's whole name, or through a single name and near birth years;
what depends on relations is looked up along these alone.  Pairs found so are
exactly those that the rule would accept among all pairs.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from heirloom.cut import cut
from heirloom.functions import names as N
from heirloom.functions import text as T
from heirloom.functions import vocab as V
from heirloom.operators.components import connected_components
from heirloom.operators.living import pair_links

#: Attributes that a merged entity takes from the best ranked record that has them.
ATTRIBUTES = ("birth_year", "death_year", "birth_place", "death_place", "gender", "species", "occupation", "description")
_SAME, _NEAR, _FAR = 8, 12, 15
_PROFILE = ("kind", "g", "b", "d", "toks", "patr")


def features(entities: DataFrame) -> DataFrame:
    """``id`` and what the rule compares; rows without an id or a core name take no part."""
    name = F.col("canonical_name")
    f = entities.where("entity_id is not null").select(
        F.col("entity_id").alias("id"), F.nullif(F.lower(F.trim("entity_type")), F.lit("")).alias("kind"), T.gender(F.col("gender")).alias("g"), T.strict_year(F.col("birth_year")).alias("b"),
        T.strict_year(F.col("death_year")).alias("d"), N.person_tokens(name).alias("toks"), N.patronymic(name).alias("patr"),
    )
    f = f.withColumn("core", N.core_tokens(F.col("toks"))).where(F.size("core") > 0)
    return f.withColumns({"n": F.size("core"), "first": F.get("core", F.lit(0)), "roman": T.roman_numeral(F.array_join("toks", " "))})


def same_person(l: str, r: str, kin: Column, anchor: Column, near: Column) -> Column:  # noqa: E741
    """The rule over two feature structs; ``kin``: a stated kinship, ``anchor``: a strong loose relation, ``near``: alike single names with an anchor or a common neighbour."""
    a, b = (lambda c: F.col(f"{l}.{c}")), (lambda c: F.col(f"{r}.{c}"))
    yes, no = F.lit(True), F.lit(False)
    agree = lambda c: F.coalesce(a(c) == b(c), yes)
    within = lambda c, y, unknown: F.coalesce(F.abs(a(c) - b(c)) <= y, unknown)
    kinds = agree("kind") | (a("kind").isin("human", "other_living") & b("kind").isin("human", "other_living"))
    fits = kinds & agree("g") & within("b", _FAR, yes) & within("d", _FAR, yes) & agree("roman") & agree("patr")
    one_roman, same_roman = a("roman").isNull() != b("roman").isNull(), F.coalesce(a("roman") == b("roman"), no)
    born = within("b", _SAME, no)
    few, many = F.least(a("n"), b("n")), F.greatest(a("n"), b("n"))

    def begins(c: str) -> Column:
        k = F.least(F.size(a(c)), F.size(b(c)))
        return (k >= 2) & (F.slice(a(c), F.lit(1), k) == F.slice(b(c), F.lit(1), k))

    first = a("first") == b("first")
    year = within("b", _NEAR, no)
    return fits & (
        F.when(a("core") == b("core"), (~one_roman | born) & ((many > 1) | born)).when(kin, no).when(first & same_roman & begins("toks"), yes)
        .when(first & (many <= 1), year).when(first & (few <= 1), year | (same_roman & anchor)).otherwise(near | begins("core"))
    )


def _links(rel: DataFrame) -> DataFrame:
    """``a, b, kin, anchor`` of the pairs that have a relation."""
    p = pair_links(rel.where("src is not null and tgt is not null"))
    kin = F.arrays_overlap("types", F.array(*[F.lit(x) for x in V.KIN_TYPES]))
    loose = F.arrays_overlap("types", F.array(*[F.lit(x) for x in V.ANCHOR_TYPES]))
    return p.select("a", "b", kin.alias("kin"), (~kin & loose & ((F.col("confidence") >= 0.92) | (F.col("support") >= 2))).alias("anchor"))


def merge_edges(entities: DataFrame, rel: DataFrame) -> DataFrame:
    """``a, b``: edges whose components are the groups of entities to merge."""
    f = cut(features(entities))
    links = cut(_links(rel))
    whole = F.struct(*[c for c in f.columns if c != "id"])
    x = f.select("id", whole.alias("x"))
    linked = links.join(x.toDF("a", "l"), "a").join(x.toDF("b", "r"), "b")
    alike = lambda: F.greatest(N.token_ratio(N.token_root(F.col("l.first")), N.token_root(F.col("r.first"))), N.token_ratio(F.col("l.first"), F.col("r.first"))) >= 0.9
    kin = cut(linked.where("kin and (l.first = r.first or (l.n = 1 and r.n = 1))").where((F.col("l.first") == F.col("r.first")) | alike()).select("a", "b"))
    # Stated kin of like names must not merge: they are profiles of their own.
    own = kin.select(F.col("a").alias("id")).union(kin.select("b")).distinct().withColumn("own", F.col("id"))
    text = [F.coalesce(F.array_join(c, " ") if c == "toks" else F.col(c).cast("string"), F.lit("\0")) for c in _PROFILE]
    member = cut(f.join(own, "id", "left").select("id", F.md5(F.concat_ws("\1", *text, F.coalesce(F.col("own").cast("string"), F.lit("\0")))).alias("key"), whole.alias("x")))
    prof = cut(member.groupBy("key").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("size"), F.any_value("x").alias("x")))
    join = lambda c: F.array_join(c, " ")
    left, right = prof.select("key", "x"), prof.select(F.col("key").alias("key2"), F.col("x").alias("y"))
    starts = lambda c: F.transform(F.sequence(F.lit(2), F.size(c) - 1), lambda k: F.array_join(F.slice(c, F.lit(1), k), " "))

    def longer(c: str) -> DataFrame:
        """Profiles whose tokens go on after another's whole ones."""
        whole_, more = left.where(F.size(f"x.{c}") >= 2).withColumn("at", join(f"x.{c}")), right.where(F.size(f"y.{c}") >= 3).withColumn("at", F.explode(starts(F.col(f"y.{c}"))))
        return whole_.join(more, "at").select("key", "key2")

    decade = lambda b: F.floor(b / (_NEAR + 1))
    single = left.where("x.n = 1 and x.b is not null").select("key", F.col("x.first").alias("first"), F.explode(F.array(*[decade(F.col("x.b")) + i for i in (-1, 0, 1)])).alias("decade"))
    dated = right.where("y.b is not null").select("key2", F.col("y.first").alias("first"), decade(F.col("y.b")).alias("decade"))
    equal = left.withColumn("at", join("x.core")).join(right.withColumn("at", join("y.core")), "at").where("key < key2").select("key", "key2")
    # Equal tokens with different cores do not occur; equal cores are met above.
    cand = reduce(DataFrame.union, [equal, longer("core"), longer("toks"), single.join(dated, ["first", "decade"]).select("key", "key2")]).where("key <> key2")
    cand = cand.select(F.least("key", "key2").alias("key"), F.greatest("key", "key2").alias("key2")).distinct()
    met = cand.join(prof.select("key", F.col("rep").alias("a0"), F.col("x").alias("l")), "key").join(prof.select(F.col("key").alias("key2"), F.col("rep").alias("b0"), F.col("x").alias("r")), "key2")
    met = met.withColumns({"a": F.least("a0", "b0"), "b": F.greatest("a0", "b0")}).join(kin.withColumn("kin", F.lit(True)), ["a", "b"], "left")
    off = F.lit(False)
    good = cut(met.where(same_person("l", "r", F.coalesce("kin", off), off, off)).select("a", "b", "key", "key2"))
    alone = prof.where((F.col("size") > 1) & ((F.col("x.n") > 1) | F.col("x.b").isNotNull())).select("key")
    joined = good.select("key").union(good.select("key2")).union(alone).distinct()
    within = member.join(joined, "key", "left_semi").join(prof.select("key", "rep"), "key").select(F.col("rep").alias("a"), F.col("id").alias("b"))

    anchored = linked.where("anchor").withColumn("near", (F.col("l.n") == 1) & (F.col("r.n") == 1) & alike())
    anchored = anchored.where(same_person("l", "r", F.col("kin"), F.lit(True), F.col("near"))).select("a", "b")
    # Single names around one neighbour: a profile stands there once, so a hub costs its distinct names.
    around = links.select("a", F.col("b").alias("hub")).union(links.select("b", "a")).toDF("id", "hub").join(member.where("x.n = 1"), "id")
    around = cut(around.select("hub", "key", "id", "x"))
    stand = around.groupBy("hub", "key").agg(F.min("id").alias("rep"), F.any_value("x").alias("x"))
    pair = stand.select("hub", F.col("key").alias("k1"), F.col("rep").alias("a0"), F.col("x").alias("l")).join(stand.select("hub", F.col("key").alias("k2"), F.col("rep").alias("b0"), F.col("x").alias("r")), "hub")
    pair = pair.where((F.col("k1") < F.col("k2")) & (F.col("l.first") != F.col("r.first")) & (F.abs(F.length("l.first") - F.length("r.first")) <= 3))
    pair = pair.withColumn("near", alike()).where(F.col("near") & same_person("l", "r", off, off, F.col("near")))
    pair = cut(pair.withColumns({"a": F.least("a0", "b0"), "b": F.greatest("a0", "b0")}).join(kin, ["a", "b"], "left_anti").select("hub", "k1", "k2", "a", "b"))
    there = pair.select("hub", F.col("k1").alias("key")).union(pair.select("hub", F.col("k2"))).distinct()
    ids = around.join(there, ["hub", "key"], "left_semi").join(stand.select("hub", "key", "rep"), ["hub", "key"]).select(F.col("rep").alias("a"), F.col("id").alias("b")).union(pair.select("a", "b"))
    return good.select("a", "b").union(within).union(anchored).union(ids).where("a <> b").distinct()


def merge_entities(entities: DataFrame, rel: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Merged entities, and the map ``entity_id, representative`` of all entities.

    The representative is the record with the most known years, then with a
    numeral, then with more name tokens, more confidence, more aliases, then the
    smallest id.  Attributes it lacks come from the others in this order.
    """
    comp = connected_components(merge_edges(entities, rel), "a", "b")
    e = entities.where("entity_id is not null").join(comp.toDF("entity_id", "_c"), "entity_id", "left").withColumn("_c", F.coalesce("_c", "entity_id"))
    toks = N.person_tokens(F.col("canonical_name"))
    core = F.size(N.core_tokens(toks))
    known = sum((F.when(T.strict_year(F.col(c)).isNotNull(), 1).otherwise(0) for c in ("birth_year", "death_year")), F.lit(0))
    aliases = F.coalesce("aliases", F.array().cast("array<string>")) if "aliases" in entities.columns else F.array().cast("array<string>")
    conf = F.coalesce("confidence", F.lit(0.0))
    order = F.struct(-known, F.when(T.roman_numeral(F.array_join(toks, " ")).isNotNull(), 0).otherwise(1), -F.when(core > 0, core).otherwise(F.size(toks)), -conf, -F.size(aliases), F.col("entity_id"))
    e = cut(e.withColumns({"_o": order, "_al": aliases}))
    attrs = [c for c in ATTRIBUTES if c in entities.columns]
    rest = [c for c in entities.columns if c not in (*attrs, "entity_id", "confidence", "aliases")]
    g = e.groupBy("_c").agg(
        F.min_by("entity_id", "_o").alias("entity_id"), *[F.min_by(c, "_o").alias(c) for c in rest], *[F.min_by(c, F.when(F.col(c).isNotNull(), F.col("_o"))).alias(c) for c in attrs],
        F.max(conf).alias("confidence"), F.min_by("_al", "_o").alias("_al"), F.count(F.lit(1)).alias("n_merged"),
    )
    said = e.select("_c", F.explode(F.concat("_al", F.array("canonical_name"))).alias("alias")).select("_c", F.trim("alias").alias("alias")).where("alias <> ''").distinct()
    said = said.groupBy("_c").agg(F.sort_array(F.collect_list("alias")).alias("_said"))
    g = g.join(said, "_c", "left")
    g = g.withColumn("aliases", F.when(F.col("n_merged") == 1, F.col("_al")).otherwise(F.filter("_said", lambda x: ~x.eqNullSafe(F.trim("canonical_name")))))
    mapping = e.select(F.col("entity_id").alias("member"), "_c").join(g.select("_c", F.col("entity_id").alias("representative")), "_c").select(F.col("member").alias("entity_id"), "representative")
    return g.select("entity_id", *rest, *attrs, "confidence", "aliases", "n_merged"), mapping


def merge_groups(mapping: DataFrame) -> DataFrame:
    """``representative, members`` of the groups of more than one."""
    return mapping.groupBy("representative").agg(F.sort_array(F.collect_list("entity_id")).alias("members")).where(F.size("members") > 1)


def remap(rel: DataFrame, mapping: DataFrame) -> DataFrame:
    """Relations between representatives; self-relations go, and symmetric ones run from the smaller id."""
    for end in ("src", "tgt"):
        rel = rel.join(mapping.select(F.col("entity_id").alias(end), F.col("representative").alias("_r")), end, "left").withColumn(end, F.coalesce("_r", end)).drop("_r")
    both = F.coalesce(F.col("symmetric"), F.lit(False)) | ~F.coalesce(F.col("directed"), F.lit(True))
    turn = both & (F.col("src") > F.col("tgt"))
    rest = [c for c in rel.columns if c not in ("src", "tgt", "symmetric")]
    return rel.where("src <> tgt").select(F.when(turn, F.col("tgt")).otherwise(F.col("src")).alias("src"), F.when(turn, F.col("src")).otherwise(F.col("tgt")).alias("tgt"), both.alias("symmetric"), *rest)
