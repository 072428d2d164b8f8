"""Living-graph rules: roll-up, typing, guardrails, role limits and derived kinship."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from heirloom.cut import cut, gathered, stored
from heirloom.functions import names as N
from heirloom.functions import text as T
from heirloom.functions import vocab as V
from heirloom.operators.variants import join_alike


_RELATION = ("src", "tgt", "type", "directed", "symmetric")


def roll_up(rel: DataFrame, order: str | None = None) -> DataFrame:
    """One row per (src, tgt, lower type, directed, symmetric): highest confidence, summed support; no self-loops.

    With ``order``, a column that puts the relations in the order they came in, all other columns are those of the first
    row, and ``evidence`` and ``quote`` (strings) gather: the text of what is known is the first row's
    evidence, what was added, and the first row's quote, joined by spaces; a later row's text (evidence, then quote)
    is added where it is no part of that yet.  Texts that repeat count at their first place, so that a pair
    told of in very many equal words costs one row for each text; it makes a difference only to a text that was
    part of what is known by running over into the first row's quote.  The gathered text comes back as ``quote``.
    """
    r = rel.where("src <> tgt").withColumn("type", F.lower(T.relation_type(F.col("type"))))
    aggs = [F.max(F.coalesce("confidence", F.lit(0.0))).alias("confidence"), F.sum(F.greatest(F.coalesce("support_count", F.lit(1)), F.lit(1))).alias("support_count")]
    mark = lambda b: F.initcap(F.col(b).cast("string"))
    rid = F.concat(F.lit("rel-"), F.md5(F.concat_ws("|", "src", "tgt", "type", mark("directed"), mark("symmetric"))))
    if order is None:
        return r.groupBy(*_RELATION).agg(*aggs).withColumn("relation_id", rid)
    told = {"evidence", "quote"}
    rest = [c for c in r.columns if c not in {*_RELATION, *told, "confidence", "support_count", "relation_id", order}]
    has = lambda c: F.coalesce(F.trim(F.col(c)), F.lit("")) if c in r.columns else F.lit("")
    r = r.withColumns({"_ev": has("evidence"), "_own": has("quote")}).withColumn("_said", F.trim(F.concat_ws(" ", F.nullif("_ev", F.lit("")), F.nullif("_own", F.lit("")))))
    first = F.struct(F.col(order), "_ev", "_own", *[F.col(c).alias(f"_r{i}") for i, c in enumerate(rest)])
    # Equal texts meet in partial sums; what is left of a pair is put in order and read once.
    texts = r.groupBy(*_RELATION, "_said").agg(F.max(F.coalesce("confidence", F.lit(0.0))).alias("confidence"), F.sum(F.greatest(F.coalesce("support_count", F.lit(1)), F.lit(1))).alias("support_count"), F.min(F.col(order)).alias("_at"), F.min_by(first, order).alias("_first"))
    g = texts.groupBy(*_RELATION).agg(F.max("confidence").alias("confidence"), F.sum("support_count").alias("support_count"), F.min_by("_first", "_at").alias("_first"), F.array_sort(F.collect_list(F.when(F.col("_said") != "", F.struct("_at", "_said")))).alias("_all"))
    join = lambda a, b: F.concat_ws(" ", F.nullif(a, F.lit("")), F.nullif(b, F.lit("")))
    g = g.withColumns({"_ev": F.col("_first._ev"), "_own": F.col("_first._own")})
    # The state holds the evidence so far and, unchanged, the first row's own quote.
    state = F.struct(F.col("_ev").alias("ev"), F.col("_own").alias("own"))
    more = lambda s, x: F.struct(F.when(F.contains(join(s["ev"], s["own"]), x["_said"]), s["ev"]).otherwise(join(s["ev"], x["_said"])).alias("ev"), s["own"].alias("own"))
    text = F.aggregate("_all", state, more, lambda s: join(s["ev"], s["own"]))
    return g.select(*_RELATION, "confidence", "support_count", *[F.col(f"_first._r{i}").alias(c) for i, c in enumerate(rest)], text.alias("quote")).withColumn("relation_id", rid)


def append_rule(rule: str, when: Column) -> Column:
    """``inference_rule`` with one more rule where ``when`` holds."""
    old = F.nullif(F.trim("inference_rule"), F.lit(""))
    return F.when(when, F.concat_ws(";", old, F.lit(rule))).otherwise(F.col("inference_rule"))


def pair_links(rel: DataFrame) -> DataFrame:
    """Unordered pairs: highest confidence, summed support, types."""
    return rel.where("src <> tgt").groupBy(F.least("src", "tgt").alias("a"), F.greatest("src", "tgt").alias("b")).agg(
        F.max("confidence").alias("confidence"), F.sum(F.greatest(F.coalesce("support_count", F.lit(1)), F.lit(1))).alias("support"), F.sort_array(F.collect_set(F.lower("type"))).alias("types")
    )


def filter_types(rel: DataFrame, include: set[str] | None = None, exclude: set[str] | None = None) -> DataFrame:
    """Keep included types and drop excluded ones; ``parent_child`` stands for all parent types."""
    wide = lambda s: sorted({t for x in s for t in (V.PARENT_TYPES if x == "parent_child" else [x])})
    t = F.lower(T.relation_type(F.col("type")))
    if include:
        rel = rel.where(t.isin(wide(include)))
    return rel.where(~t.isin(wide(exclude))) if exclude else rel


def _with_people(rel: DataFrame, entities: DataFrame) -> DataFrame:
    e = entities.select("entity_id", T.gender(F.col("gender")).alias("g"), T.strict_year(F.col("birth_year")).alias("b"), T.strict_year(F.col("death_year")).alias("d"), F.lit(True).alias("known"))
    for side in ("src", "tgt"):
        rel = rel.join(e.select(F.col("entity_id").alias(side), *[F.col(c).alias(f"{side}_{c}") for c in ("g", "b", "d", "known")]), side, "left")
    return rel


_SIDE = [f"{s}_{c}" for s in ("src", "tgt") for c in ("g", "b", "d", "known")]


def implausible(parent: str, child: str, kind: Column) -> Column:
    """Why a parent relation cannot be, as an array of reasons."""
    low, high = V.PARENT_GAP
    gap = F.col(f"{child}_b") - F.col(f"{parent}_b")
    checks = [
        ((kind == "father_of") & (F.col(f"{parent}_g") != "male"), "father_of_requires_male_source"),
        ((kind == "mother_of") & (F.col(f"{parent}_g") != "female"), "mother_of_requires_female_source"),
        (gap < low, "parent_too_young"),
        (gap > high, "parent_too_old"),
        (F.col(f"{parent}_d") + 1 < F.col(f"{child}_b"), "parent_died_before_child_birth"),
        (F.col(f"{parent}_b") > F.col(f"{child}_d"), "parent_born_after_child_death"),
    ]
    return F.array_compact(F.array(*[F.when(c, F.lit(n)) for c, n in checks]))


def parent_type(g: Column) -> Column:
    return T.gendered("father_of", "mother_of", "parent_of", g)


def specialise_parents(rel: DataFrame, entities: DataFrame) -> DataFrame:
    """``parent_child`` becomes the type of the parent's gender."""
    r = _with_people(rel, entities)
    return r.withColumn("type", F.when(F.lower("type") == "parent_child", parent_type(F.col("src_g"))).otherwise(F.col("type"))).drop(*_SIDE)


def guard_timeline(rel: DataFrame, entities: DataFrame) -> DataFrame:
    """Turn implausible parent relations around where that is plausible, else make them ``relative``.

    Adds ``action`` (null, reversed, downgraded) and ``reasons``.
    """
    r = _with_people(rel, entities).withColumn("_t", F.lower("type"))
    judged = F.col("_t").isin(V.PARENT_TYPES) & F.col("src_known") & F.col("tgt_known")
    r = r.withColumns({"reasons": F.when(judged, implausible("src", "tgt", F.col("_t"))), "_rt": parent_type(F.col("tgt_g"))})
    r = r.withColumn("_rr", implausible("tgt", "src", F.col("_rt")))
    r = r.withColumn("action", F.when(F.size("reasons") > 0, F.when(F.size("_rr") == 0, "reversed").otherwise("downgraded")))
    turned = F.coalesce(F.col("action") == "reversed", F.lit(False))
    return r.select(
        *[c for c in rel.columns if c not in ("src", "tgt", "type")],
        F.when(turned, F.col("tgt")).otherwise(F.col("src")).alias("src"),
        F.when(turned, F.col("src")).otherwise(F.col("tgt")).alias("tgt"),
        F.when(turned, F.col("_rt")).when(F.col("action") == "downgraded", "relative").otherwise(F.col("type")).alias("type"),
        "action",
        "reasons",
    )


def limit_roles(rel: DataFrame, order: list[Column], limits: dict[str, int] | None = None) -> DataFrame:
    """At most one father, one mother and two parents of no stated role per child; the rest become ``relative``.

    ``order`` ranks the relations of a role, best first.  Adds ``demoted``.
    """
    limits = limits or {"father_of": 1, "mother_of": 1, "parent_of": 2}
    cap = F.create_map(*[x for k, v in limits.items() for x in (F.lit(k), F.lit(v))])
    t = F.lower("type")
    rank = F.row_number().over(Window.partitionBy("tgt", t).orderBy(*order))
    over = F.coalesce(rank > F.element_at(cap, t), F.lit(False))
    return rel.withColumn("demoted", over).withColumn("type", F.when(F.col("demoted"), "relative").otherwise(F.col("type")))


#: Distinct quotes with the names of both ends that are judged once and told to every task (a few tens of MB); where there are more, rows are judged one by one.
JUDGED = 200_000

#: The role that a relation gives a parent, and how many of it a child has.
ROLES = {"father_of": ("father", 1), "mother_of": ("mother", 1), "parent_of": ("parent", 2)}


def resolve_role_conflicts(rel: DataFrame, entities: DataFrame, order: str = "relation_id", tie: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """Keep one father, one mother and two parents of no stated role per child; the others become ``relative``.

    Relations ``src, tgt, type, confidence, directed, symmetric`` and, where there
    are any, ``quote, polarity, support_count, inference_rule``.  Those stay whose
    quote names the source as the parent, that are not negative, of high
    confidence and support, with long quotes, and not promoted from a quote; then
    by the columns ``tie``, or by ``order`` where there are none.  A demoted row is dropped where its pair
    is ``relative`` already, or by an earlier demoted row.  Adds ``demoted``.  Also returns the conflicts:
    ``child, role, role_limit, kept, downgraded`` (ids by rank).
    """
    has = lambda c, kind: F.col(c) if c in rel.columns else F.lit(None).cast(kind)
    tie = tie or (order,)
    e = entities.select("entity_id", F.coalesce("canonical_name", F.col("entity_id").cast("string")).alias("_name"))
    role = F.create_map(*[x for k, (name, _) in ROLES.items() for x in (F.lit(k), F.lit(name))])
    limit = F.create_map(*[x for name, n in ROLES.values() for x in (F.lit(name), F.lit(n))])
    r = rel.withColumn("_role", F.element_at(role, F.lower(T.relation_type(F.col("type")))))
    # Only children with more parents of a role than may be are ranked.
    many = r.where("_role is not null and tgt is not null").groupBy("tgt", "_role").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > F.element_at(limit, F.col("_role")))
    r = stored(r.join(many.withColumn("_many", F.lit(True)).drop("_n"), ["tgt", "_role"], "left"))
    rivals = r.where("_many").join(e.toDF("src", "_s"), "src", "left").join(e.toDF("tgt", "_t"), "tgt", "left")
    quote = F.coalesce(has("quote", "string"), F.lit(""))
    rivals = stored(rivals.withColumns({"_s": F.coalesce("_s", F.col("src").cast("string")), "_t": F.coalesce("_t", F.col("tgt").cast("string"))}))
    anchor = N.parent_anchor(T.cue_text(F.col("_q")), F.col("_s"), F.col("_t"), F.lit(True))
    rivals = rivals.withColumn("_q", quote)
    told, n_told = gathered(rivals.select("_q", "_s", "_t").distinct())
    if n_told <= JUDGED:
        rivals = join_alike(rivals, F.broadcast(cut(told.withColumn("_anchor", anchor))), ("_q", "_s", "_t"))
    else:
        rivals = rivals.withColumn("_anchor", anchor)
    rank = [
        F.desc("_anchor"), F.coalesce(F.lower(F.trim(has("polarity", "string"))) == "negative", F.lit(False)), F.desc(F.coalesce("confidence", F.lit(0.0))),
        F.desc(F.coalesce(has("support_count", "int"), F.lit(0))), F.desc(F.length(quote)), F.coalesce(has("inference_rule", "string") == "evidence_parent_cue", F.lit(False)), *map(F.col, tie),
    ]
    ranked = stored(rivals.withColumn("_rank", F.row_number().over(Window.partitionBy("tgt", "_role").orderBy(*rank))).withColumn("_over", F.col("_rank") > F.element_at(limit, F.col("_role"))))
    ids = lambda over: F.transform(F.sort_array(F.collect_list(F.when(F.col("_over") == over, F.struct("_rank", F.col(order).alias("id"))))), lambda x: x["id"])
    conflicts = ranked.groupBy(F.col("tgt").alias("child"), F.col("_role").alias("role")).agg(F.element_at(limit, F.first("_role")).alias("role_limit"), ids(False).alias("kept"), ids(True).alias("downgraded"))
    kept = r.where("_many is null").select(*rel.columns).unionByName(ranked.where("not _over").select(*rel.columns)).withColumn("demoted", F.lit(False))
    already = kept.where(F.lower(T.relation_type(F.col("type"))) == "relative").select("src", "tgt").distinct()
    first = F.row_number().over(Window.partitionBy("src", "tgt").orderBy(*tie))
    down = ranked.where("_over").join(already, ["src", "tgt"], "left_anti").withColumn("_first", first).where("_first = 1")
    new = {"type": F.lit("relative"), "directed": F.lit(False), "symmetric": F.lit(True), "inference_rule": F.concat_ws(";", F.nullif(F.trim(has("inference_rule", "string")), F.lit("")), F.lit("parent_role_conflict_downgrade"))}
    down = down.select(*[new[c].alias(c) if c in new else F.col(c) for c in rel.columns]).withColumn("demoted", F.lit(True))
    return kept.unionByName(down), conflicts


def type_list(csv: str) -> set[str]:
    """Relation types of a comma-separated argument."""
    return {x.strip().lower() for x in csv.split(",") if x.strip()}


#: Pairs that one task makes, about, and tasks of one step at most.
PAIRS_EACH = 500_000
PAIRS_TASKS = 1_000


def derive_kinship(rel: DataFrame, entities: DataFrame) -> DataFrame:
    """Siblings, aunts and uncles, nieces and nephews, grandparents and cousins that follow from one pass over ``rel``.

    Returns ``src, tgt, type, confidence, inference_rule, relation_id``.  Triples
    that ``rel`` has already, and self-relations, are left out; of several rules
    for a triple the first in order stays.

    Siblings share a hub: a parent, or the link that an uncle of someone makes to that one's parents.  A pair that several
    hubs or paths lead to is made at the first of them alone, which each row can tell from the hubs that it carries; so
    pairs, of which there are far more than people, are not brought together to be told apart.  Where a child has one path alone, no hubs
    are compared.  All pairs are given out: their number, not that of the relations, is what it costs.
    """
    known = entities.select("entity_id").distinct()
    r = rel.where("src <> tgt").join(known.select(F.col("entity_id").alias("src")), "src", "left_semi").join(known.select(F.col("entity_id").alias("tgt")), "tgt", "left_semi")
    t = F.lower("type")
    parent = cut(r.where(t.isin(V.PARENT_TYPES)).select(F.col("src").alias("p"), F.col("tgt").alias("c")).distinct())
    avuncular = r.where(t.isin(V.AVUNCULAR_TYPES)).select(F.col("src").alias("u"), F.col("tgt").alias("c")).union(r.where(t.isin("nephew_of", "niece_of", "nibling_of")).select(F.col("tgt").alias("u"), F.col("src").alias("c"))).distinct()
    by_uncle = avuncular.join(parent, "c").where("u <> p").select(F.col("u").alias("a"), F.col("p").alias("b"))
    by_uncle = cut(by_uncle.union(by_uncle.select("b", "a")).distinct())
    link = F.struct(F.lit(1).alias("kind"), F.least("a", "b").alias("x"), F.greatest("a", "b").alias("y"))
    hub = parent.select(F.struct(F.lit(0).alias("kind"), F.col("p").alias("x"), F.col("p").alias("y")).alias("hub"), F.col("c").alias("id")).union(by_uncle.select(link, F.col("a")))
    hubs = hub.groupBy("id").agg(F.collect_list("hub").alias("hubs"))
    names = {
        "sibling": ("brother_of", "sister_of", "sibling_of"), "aunt": ("uncle_of", "aunt_of", "aunt_uncle_of"), "niece": ("nephew_of", "niece_of", "nibling_of"),
        "grandparent": ("grandfather_of", "grandmother_of", "grandparent_of"), "grandchild": ("grandson_of", "granddaughter_of", "grandchild_of"), "parent": ("father_of", "mother_of", "parent_of"), "cousin": ("cousin_of",) * 3,
    }

    def told(role: str, who: str, g: str = "g") -> list[Column]:
        """The type of a role by the gender, and what the id of a row of it begins with: made once for each person, not for each pair."""
        kind = T.gendered(*names[role], F.col(g))
        return [kind.alias("type"), F.concat(F.col(who), F.lit("|"), kind, F.lit("|")).alias("head")]

    # The gender of whoever a type is made for comes along, from here on.
    e = entities.groupBy("entity_id").agg(F.max(T.gender(F.col("gender"))).alias("g"))
    member = cut(hub.join(hubs, "id").join(e.toDF("id", "g"), "id", "left").withColumn("many", F.size("hubs") > 1))
    # Of each child the parents that have hubs, with these; of many, where paths can lead to the same pair.
    lines = parent.join(hubs.withColumnRenamed("id", "p"), "p").groupBy("c").agg(F.collect_list(F.struct("p", "hubs")).alias("lines"))
    lines = lines.withColumn("many", (F.size("lines") > 1) | (F.size(F.col("lines")[0]["hubs"]) > 1))
    child = cut(member.select("hub", F.col("id").alias("p")).join(parent, "p").join(lines, "c").join(e.toDF("c", "c_g"), "c", "left"))
    size = lambda df, m, n: df.select("hub", F.lit(m).alias("m"), F.lit(n).alias("n"), F.col("many").cast("int").alias("t"))
    sizes = size(member, 1.0, 0.0).unionByName(size(child, 0.0, 1.0)).groupBy("hub").agg(F.sum("m").alias("m"), F.sum("n").alias("n"), F.sum(F.col("n") * F.col("t")).alias("t"))
    n_sib, n_aunt, n_cousin, tangled = (x or 0 for x in sizes.agg(F.sum(F.col("m") * F.col("m")), F.sum(F.col("m") * F.col("n")), F.sum(F.col("n") * F.col("n")), F.sum("t")).first())

    def pairs(left: DataFrame, right: DataFrame, n: float) -> DataFrame:
        """Few rows make very many pairs, so tasks are as many as the pairs fill."""
        tasks = int(min(PAIRS_TASKS, n // PAIRS_EACH + 1))
        return left.repartition(tasks, "hub").join(right.repartition(tasks, "hub"), "hub")

    c = V.CONFIDENCE
    first = lambda ways: F.array_min(ways)
    shared = lambda x, y: F.array_intersect(x, y)
    by_line = lambda lines, other, other_hubs, tail: F.flatten(F.transform(F.filter(lines, lambda x: x["p"] != other), lambda x: F.transform(shared(x["hubs"], other_hubs), lambda h: F.struct(x["p"].alias("p"), *tail, h.alias("hub")))))
    row = lambda df, a, b, conf, rule: df.select(F.col(a).alias("src"), F.col(b).alias("tgt"), "type", F.lit(c[conf]).alias("confidence"), F.lit(rule).alias("inference_rule"), "head").where("src <> tgt")
    u = member.select("hub", F.col("id").alias("u"), F.col("hubs").alias("u_hubs"), F.col("many").alias("u_many"))
    sib = pairs(member.select("hub", F.col("id").alias("a"), "hubs", "many", *told("sibling", "id")), u, n_sib).where("a <> u").where(~F.col("many") | ~F.col("u_many") | (F.col("hub") == first(shared("hubs", "u_hubs"))))
    # Where one path alone leads to a child's aunts, or to its cousins and back, there is nothing to tell apart.
    only, by_many = child.where("not many"), child.where("many")
    aunts = member.select("hub", F.col("id").alias("u"), F.col("hubs").alias("u_hubs"), *told("aunt", "id"))
    nieces = lambda df: df.select("hub", "p", "c", "lines", *told("niece", "c", "c_g"))
    plain = lambda df: df.drop("lines", "u_hubs", "d_lines")
    others = lambda df: df.select("hub", F.col("p").alias("u"), F.col("c").alias("d"), F.col("lines").alias("d_lines"))
    cousins = lambda df: df.select("hub", "p", "c", "lines", *told("cousin", "c", "c_g"))
    aunt = pairs(only.select("hub", "p", "c"), plain(aunts), n_aunt).where("p <> u")
    niece = pairs(plain(nieces(only)), u.select("hub", "u"), n_aunt).where("p <> u")
    cousin = pairs(plain(cousins(only)), plain(others(only)), n_cousin).where("p <> u and c <> d")
    if tangled:
        ways = by_line("lines", F.col("u"), F.col("u_hubs"), [])
        of_line = lambda df: df.where("p <> u").where(F.struct("p", "hub") == first(ways))
        aunt = aunt.select("u", "c", "type", "head").unionByName(of_line(pairs(by_many.select("hub", "p", "c", "lines"), aunts, n_aunt)).select("u", "c", "type", "head"))
        niece = niece.select("u", "c", "type", "head").unionByName(of_line(pairs(nieces(by_many), u.select("hub", "u", "u_hubs"), n_aunt)).select("u", "c", "type", "head"))
        both = F.flatten(F.transform("d_lines", lambda y: by_line("lines", y["p"], y["hubs"], [y["p"].alias("u")])))
        of_both = lambda x, y: pairs(cousins(x), others(y), n_cousin).where("p <> u and c <> d").where(F.struct("p", "u", "hub") == first(both)).select("c", "d", "type", "head")
        cousin = cousin.select("c", "d", "type", "head").unionByName(of_both(by_many, child)).unionByName(of_both(only, by_many))
    gp = parent.select(F.col("p").alias("gp"), F.col("c").alias("p")).join(parent, "p").select("gp", "c").distinct().join(e.toDF("gp", "gp_g"), "gp", "left").join(e.toDF("c", "c_g"), "c", "left")
    transfer = by_uncle.join(parent.select(F.col("c").alias("a"), "p"), "a").select(F.col("p").alias("src"), F.col("b").alias("tgt")).where("src <> tgt").distinct()
    transfer = _with_people(transfer, entities)
    transfer = transfer.where(F.size(implausible("src", "tgt", parent_type(F.col("src_g")))) == 0).select("src", "tgt", *told("parent", "src", "src_g"))
    # A role has one rule, and no two roles have a type in common.
    every = (
        row(sib, "a", "u", "sibling", "shared_parent")
        .unionByName(row(aunt, "u", "c", "avuncular", "parent_sibling"))
        .unionByName(row(niece, "c", "u", "avuncular", "parent_sibling_inverse"))
        .unionByName(row(gp.select("gp", "c", *told("grandparent", "gp", "gp_g")), "gp", "c", "grand", "two_hop_parent_child"))
        .unionByName(row(gp.select("gp", "c", *told("grandchild", "c", "c_g")), "c", "gp", "grand", "two_hop_parent_child_inverse"))
        .unionByName(row(cousin, "c", "d", "cousin", "parents_are_siblings"))
    )
    # Only types that can follow are looked up among those that are there; parents follow from few rows.
    old = rel.select("src", F.lower("type").alias("type"), "tgt")
    moved = row(transfer, "src", "tgt", "transfer", "avuncular_parent_transfer").join(old.where(F.col("type").isin(*names["parent"])), ["src", "type", "tgt"], "left_anti")
    there = cut(old.where(F.col("type").isin(sorted({x for k, v in names.items() if k != "parent" for x in v}))).distinct())
    one = (every.join(there, ["src", "type", "tgt"], "left_anti") if there.limit(1).count() else every).unionByName(moved)
    rid = F.concat(F.lit("derived-"), F.substring(F.md5(F.concat("head", "tgt")), 1, 12))
    return one.withColumn("relation_id", rid).select("src", "tgt", "type", "confidence", "inference_rule", "relation_id")
