"""Artifacts as files: JSON tables written in parallel, and DOT, GEDCOM and HTML as ordered lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from heirloom.functions import text as T
from heirloom.functions import vocab as V
from heirloom.operators.order import numbered

# Colours of relation types.
COLOURS = {
    "parent_child": "#2563eb", "parent_of": "#2563eb", "father_of": "#1d4ed8", "mother_of": "#9333ea", "spouse": "#db2777",
    "friend": "#16a34a", "enemy": "#b91c1c", "associated_with": "#7c3aed", "related_to": "#0f766e",
}
OTHER_COLOUR = "#475569"


def write_jsonl(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def write_claim_split(claims: DataFrame, folder: str) -> None:
    """Accepted, all and rejected claims, by ``status``."""
    write_jsonl(claims.where("status = 'accepted_candidate'"), f"{folder}/claims")
    write_jsonl(claims, f"{folder}/llm_claim_candidates")
    write_jsonl(claims.where("status not in ('accepted_candidate', 'empty')"), f"{folder}/llm_rejected_claims")


def _quoted(c):
    return F.replace(F.replace(F.coalesce(c, F.lit("")), F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))


def _family_id():
    return F.concat(F.lit("family-"), F.md5(F.array_join("parent_ids", ",")))


def dot_lines(people: DataFrame, families: DataFrame) -> DataFrame:
    """``part, key, no, line`` of a DOT graph; sorted by the first three they are the file."""
    q = lambda c: F.concat(F.lit('"'), _quoted(c), F.lit('"'))
    # The header lines of the file.
    head = ["digraph family_tree {", "  rankdir=LR;", '  graph [fontsize=10 fontname="Helvetica"];', '  node [fontsize=10 fontname="Helvetica"];', '  edge [fontsize=9 fontname="Helvetica"];']
    one = people.sparkSession.range(1)
    fixed = lambda part, texts: one.select(F.lit(part).alias("part"), F.lit("").alias("key"), F.posexplode(F.array(*[F.lit(t) for t in texts])).alias("no", "line"))
    p = people.select(F.lit(1).alias("part"), F.col("person_id").alias("key"), F.lit(0).alias("no"), F.concat(F.lit("  "), q(F.col("person_id")), F.lit(" [shape=box label="), q(F.coalesce("name", "person_id")), F.lit("];")).alias("line"))
    f = families.withColumn("fid", _family_id())
    edge = lambda a, b, label: F.concat(F.lit("  "), a, F.lit(" -> "), b, F.lit(f" {label};"))
    fq = q(F.col("fid"))
    couple = F.when(F.size("parent_ids") >= 2, F.array(edge(q(F.get("parent_ids", F.lit(0))), q(F.get("parent_ids", F.lit(1))), '[dir=none style=dashed label="spouse"]'))).otherwise(F.array().cast("array<string>"))
    lines = F.concat(
        F.array(F.concat(F.lit("  "), fq, F.lit(' [shape=diamond label="family"];'))),
        F.transform("parent_ids", lambda x: edge(q(x), fq, '[label="parent"]')),
        F.transform("child_ids", lambda x: edge(fq, q(x), '[label="child"]')),
        couple,
    )
    fam = f.select(F.lit(2).alias("part"), F.col("fid").alias("key"), F.posexplode(lines).alias("no", "line"))
    return fixed(0, head).unionByName(p).unionByName(fam).unionByName(fixed(3, ["}"]))


def gedcom_lines(people: DataFrame, families: DataFrame) -> DataFrame:
    """``part, key, no, line`` of a GEDCOM file.  Husband and wife are the first and second parent by id."""
    p = numbered(people, "person_id", "_i").withColumn("xref", F.concat(F.lit("@I"), "_i", F.lit("@")))
    event = lambda tag, c: F.when(F.coalesce(c, F.lit(0)) != 0, F.array(F.lit(f"1 {tag}"), F.concat(F.lit("2 DATE "), c))).otherwise(F.array().cast("array<string>"))
    indi = F.concat(F.array(F.concat(F.lit("0 "), F.col("xref"), F.lit(" INDI")), F.concat(F.lit("1 NAME "), F.coalesce("name", F.lit("Unknown")))), event("BIRT", F.col("birth_year")), event("DEAT", F.col("death_year")))
    people_lines = p.select(F.lit(1).alias("part"), F.lpad("person_id", 64, " ").alias("key"), F.posexplode(indi).alias("no", "line"))
    f = families.withColumn("fid", _family_id())
    f = numbered(f, "fid", "_i").withColumn("fx", F.concat(F.lit("0 @F"), "_i", F.lit("@ FAM")))
    who = f.select("fid", F.posexplode("parent_ids").alias("i", "person_id")).where("i < 2").select("fid", "person_id", F.when(F.col("i") == 0, "1 HUSB ").otherwise("1 WIFE ").alias("tag"), F.col("i").alias("no"))
    who = who.unionByName(f.select("fid", F.posexplode("child_ids").alias("i", "person_id")).select("fid", "person_id", F.lit("1 CHIL ").alias("tag"), (F.col("i") + 2).alias("no")))
    members = who.join(p.select("person_id", "xref"), "person_id").select(F.lit(2).alias("part"), F.col("fid").alias("key"), F.col("no") + 1, F.concat("tag", "xref").alias("line")).toDF("part", "key", "no", "line")
    fam = f.select(F.lit(2).alias("part"), F.col("fid").alias("key"), F.lit(0).alias("no"), F.col("fx").alias("line"))
    one = people.sparkSession.range(1)
    fixed = lambda part, texts: one.select(F.lit(part).alias("part"), F.lit("").alias("key"), F.posexplode(F.array(*[F.lit(t) for t in texts])).alias("no", "line"))
    return fixed(0, ["0 HEAD", "1 SOUR HEIRLOOM", "1 CHAR UTF-8"]).unionByName(people_lines).unionByName(fam).unionByName(members).unionByName(fixed(3, ["0 TRLR"]))


def html_rows(people: DataFrame) -> DataFrame:
    """Escaped table rows, one per person."""
    esc = lambda c: F.replace(F.replace(F.replace(F.coalesce(c.cast("string"), F.lit("")), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    cells = F.concat(*[F.concat(F.lit("<td>"), esc(F.col(c)), F.lit("</td>")) for c in ("person_id", "name", "birth_year", "death_year")])
    return people.select("person_id", F.concat(F.lit("<tr>"), cells, F.lit("</tr>")).alias("html"))


def write_lines(lines: DataFrame, path: str) -> None:
    """Write sorted lines as text parts whose names follow the order."""
    lines.orderBy("part", "key", "no").select("line").write.mode("overwrite").text(path)


def relation_colour(kind):
    return F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in COLOURS.items() for x in kv]), F.lower(kind)), F.lit(OTHER_COLOUR))


def relation_class(kind):
    """A CSS class of a relation type."""
    return F.concat(F.lit("rel-type-"), F.coalesce(F.nullif(T.slug(kind), F.lit("")), F.lit("related-to")))


def decade_ranks(entities: DataFrame) -> DataFrame:
    """``decade, n, anchor, before``: entities born in a decade, the first of them, and the first of the decade before that has any."""
    y = T.strict_year(F.col("birth_year"))
    e = entities.where("entity_id is not null").select("entity_id", F.lower("canonical_name").alias("name"), y.alias("y")).where("y is not null")
    d = e.groupBy((F.floor(F.col("y") / 10) * 10).cast("long").alias("decade")).agg(F.count(F.lit(1)).alias("n"), F.min_by("entity_id", F.struct("y", F.coalesce("name", F.lit("")), "entity_id")).alias("anchor"))
    # At most 251 decades.
    return d.withColumn("before", F.lag("anchor").over(Window.orderBy("decade")))


def living_dot_lines(entities: DataFrame, rel: DataFrame, max_relations: int = 400, order: str = "relation_no") -> DataFrame:
    """``part, key, no, line`` of a DOT graph of a living graph, decades of birth on ranks; the first ``max_relations`` by ``order``."""
    q = lambda c: F.concat(F.lit('"'), _quoted(c), F.lit('"'))
    one = entities.sparkSession.range(1)
    fixed = lambda part, texts: one.select(F.lit(part).alias("part"), F.lit("").alias("key"), F.posexplode(F.array(*[F.lit(t) for t in texts])).alias("no", "line"))
    font = 'fontname="Helvetica"'
    # The header lines of the file.
    head = ["digraph living_graph {", f"  graph [overlap=false splines=true ranksep=1.0 nodesep=0.35 rankdir=TB fontsize=10 {font}];", f'  node [shape=ellipse style=filled fillcolor="#f8fafc" color="#94a3b8" fontsize=10 {font}];', f'  edge [fontsize=9 {font} color="{OTHER_COLOUR}"];']
    e = entities.where("trim(entity_id) <> ''").withColumns({"_n": F.coalesce(F.nullif(F.trim("canonical_name"), F.lit("")), F.col("entity_id")), "_b": T.strict_year(F.col("birth_year"))})
    show = lambda y: F.coalesce(F.nullif(y, F.lit(0)).cast("string"), F.lit("?"))
    dead = F.col("death_year")
    note = F.when(F.col("_b").isNotNull() | (F.coalesce(dead, F.lit(0)) != 0), F.concat(F.lit("\\n("), show(F.col("_b")), F.lit("-"), show(dead), F.lit(")"))).otherwise("")
    nodes = e.select(F.lit(1).alias("part"), F.col("entity_id").alias("key"), F.lit(0).alias("no"), F.concat(F.lit("  "), q(F.col("entity_id")), F.lit(" [label="), q(F.concat("_n", note)), F.lit("];")).alias("line"))
    decade = (F.floor(F.col("_b") / 10) * 10).cast("long")
    ranked = e.where("_b is not null").select(F.lit(2).alias("part"), F.concat_ws("|", F.lpad(decade.cast("string"), 4, "0"), F.lit("1"), F.lpad(F.col("_b").cast("string"), 4, "0"), F.lower("_n"), "entity_id").alias("key"), F.lit(0).alias("no"), F.concat(F.lit("    "), q(F.col("entity_id")), F.lit(";")).alias("line"))
    d = decade_ranks(entities)
    at = lambda i: F.concat_ws("|", F.lpad(F.col("decade").cast("string"), 4, "0"), F.lit(i))
    opened = d.select(F.lit(2).alias("part"), at("0").alias("key"), F.posexplode(F.array(F.concat(F.lit("  subgraph cluster_birth_"), F.col("decade"), F.lit(" {")), F.lit('    style="invis";'), F.lit('    label="";'), F.lit("    rank=same;"))).alias("no", "line"))
    chain = F.when(F.col("before").isNotNull(), F.concat(F.lit("  "), q(F.col("before")), F.lit(" -> "), q(F.col("anchor")), F.lit(' [style="invis" weight=100 minlen=2];')))
    closed = d.select(F.lit(2).alias("part"), at("2").alias("key"), F.posexplode(F.array_compact(F.array(F.lit("  }"), chain))).alias("no", "line"))
    t = T.relation_type(F.col("type"))
    parent = F.lower(t).isin(V.PARENT_TYPES)
    none = F.coalesce("symmetric", F.lit(False)) | ~F.coalesce("directed", F.lit(True))
    label = F.when(F.col("confidence").isNotNull(), F.format_string("%s (%.2f)", t, F.col("confidence").cast("double"))).otherwise(t)
    colour = q(relation_colour(t))
    drawn = rel.orderBy(order, "src", "tgt").limit(max(0, max_relations))
    ids = e.select("entity_id")
    drawn = drawn.join(ids.toDF("src"), "src", "left_semi").join(ids.toDF("tgt"), "tgt", "left_semi")
    line = F.concat(F.lit("  "), q(F.col("src")), F.lit(" -> "), q(F.col("tgt")), F.lit(" [label="), q(label), F.lit(" color="), colour, F.lit(" fontcolor="), colour, F.lit(' arrowhead="'), F.when(none, "none").otherwise("normal"), F.lit('" class="'), relation_class(t), F.lit('" constraint="'), F.when(parent, "true").otherwise("false"), F.lit('" weight='), F.when(parent, "6").otherwise("1"), F.lit("];"))
    edges = drawn.select(F.lit(3).alias("part"), F.concat_ws("|", F.lpad(F.col(order).cast("string"), 20, "0"), "src", "tgt").alias("key"), F.lit(0).alias("no"), line.alias("line"))
    parts = [fixed(0, head), nodes, opened, ranked, closed, edges, fixed(4, ["}"])]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def type_counts(rel: DataFrame) -> DataFrame:
    """``type, n`` for a page's filter chips, most frequent first."""
    return rel.groupBy(T.relation_type(F.col("type")).alias("type")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.lower("type"))


def living_html_rows(entities: DataFrame, rel: DataFrame) -> DataFrame:
    """``section, key, html``: escaped rows of entities and relations, each relation with the class of its type."""
    esc = lambda c: F.replace(F.replace(F.replace(F.replace(F.coalesce(c.cast("string"), F.lit("")), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;")), F.lit('"'), F.lit("&quot;"))
    cells = lambda cols: F.concat(*[x for c in cols for x in (F.lit("<td>"), esc(F.col(c)), F.lit("</td>"))])
    people = entities.select(F.lit("entities").alias("section"), F.col("entity_id").alias("key"), F.concat(F.lit("<tr>"), cells(("entity_id", "canonical_name", "birth_year", "death_year")), F.lit("</tr>")).alias("html"))
    t = T.relation_type(F.col("type"))
    rows = rel.select(F.lit("relations").alias("section"), F.concat_ws("|", "src", "type", "tgt").alias("key"), F.concat(F.lit('<tr class="'), relation_class(t), F.lit('">'), cells(("src", "type", "tgt", "confidence")), F.lit("</tr>")).alias("html"))
    chips = type_counts(rel).select(F.lit("types").alias("section"), F.col("type").alias("key"), F.concat(F.lit('<button data-class="'), relation_class(F.col("type")), F.lit('">'), esc(F.col("type")), F.lit(" ("), F.col("n"), F.lit(")</button>")).alias("html"))
    return chips.unionByName(people).unionByName(rows)
