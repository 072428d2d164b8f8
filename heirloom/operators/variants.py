"""People by the forms of their names: an index that mentions, claims and questions meet once.

A person goes by the name, its normalized form, aliases and, for questions, the surfaces that were resolved to them.
All forms are normalized; empty ones count for nothing, and neither do people without an id.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from heirloom.cut import cut, stored
from heirloom.functions import text as T

#: What of a mention decides whom it can mean.
SAID = ("normalized", "birth_year", "death_year")


def join_alike(rows: DataFrame, answers: DataFrame, on: tuple[str, ...], how: str = "inner") -> DataFrame:
    """``rows`` with the other columns of ``answers``; in ``on``, nulls equal nulls."""
    right = answers.select(*[F.col(c).alias(f"_on_{c}") if c in on else F.col(c) for c in answers.columns])
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_on_{c}")) for c in on])
    return rows.join(right, same, how).drop(*[f"_on_{c}" for c in on])


def spellings(people: DataFrame, surfaces: DataFrame | None = None, also: tuple[str, ...] = ()) -> DataFrame:
    """``forms`` with columns ``also`` of the people, not yet distinct: one scan."""
    every = F.array("name", "normalized")
    if "aliases" in people.columns:
        every = F.concat(every, F.coalesce("aliases", F.array().cast("array<string>")))
    own = people.select("person_id", *also, F.explode(every).alias("variant"))
    if surfaces is not None:
        told = surfaces.select("person_id", F.explode("surfaces").alias("variant"))
        own = own.unionByName(told.join(people.select("person_id", *also).dropDuplicates(["person_id"]), "person_id"))
    return own.withColumn("variant", T.normalize_name(F.col("variant"))).where("person_id <> '' and variant <> ''")


def forms(people: DataFrame, surfaces: DataFrame | None = None) -> DataFrame:
    """``person_id, variant``: each person's distinct forms.

    ``people`` has ``person_id, name, normalized`` and may have ``aliases``, an array.  ``surfaces`` has ``person_id, surfaces``, as
    ``people.roll_up_mentions`` returns them; those of people who are not there are left out.
    """
    return spellings(people, surfaces).distinct()


def index(people: DataFrame) -> DataFrame:
    """``variant, namesakes``: for each form the people who go by it, ``person_id, birth_year, death_year`` in order of ids.

    A row is as long as the list of candidates that one mention of the form gets.
    """
    known = people.select("person_id", "birth_year", "death_year").dropDuplicates(["person_id"])
    who = F.struct("person_id", "birth_year", "death_year")
    return forms(people).join(known, "person_id").groupBy("variant").agg(F.array_sort(F.collect_list(who)).alias("namesakes"))


def meet(mentions: DataFrame, people: DataFrame, keep: dict[str, Column] | None = None, also: tuple[str, ...] = ()) -> DataFrame:
    """Each row of ``mentions`` (``normalized, birth_year, death_year``) with ``candidates`` and ``outcome``.

    ``outcome`` is ``resolved``, or why not: ``no_matching_person``, ``year_mismatch`` (``candidates`` has all of the name then),
    ``multiple_matching_people``.  Unknown years contradict nothing.  Mentions of equal name, years and columns ``also`` are answered once,
    by one row of the index.  ``keep`` has, by name, what each mention gets besides ``outcome`` instead of its ``candidates``, as columns of these two and
    of what is answered once: lists as long as all people of a name need not go out to every mention of it then.
    """
    on = (*SAID, *also)
    by_form = index(people).select(F.col("variant").alias("normalized"), F.col("namesakes").alias("_all"))
    same = lambda a, b: F.coalesce(F.col(a) == b, F.lit(True))
    fit = F.filter("_all", lambda p: same("birth_year", p["birth_year"]) & same("death_year", p["death_year"]))
    m = mentions.select(*on).distinct().join(by_form, "normalized", "left").withColumn("_fit", fit)
    n = F.size("_fit")
    outcome = F.when(F.col("_all").isNull(), "no_matching_person").when(n == 0, "year_mismatch").when(n > 1, "multiple_matching_people").otherwise("resolved")
    ids = lambda c: F.transform(c, lambda p: p["person_id"])
    found = F.when(F.col("_all").isNull(), F.array().cast("array<string>")).when(n > 0, ids("_fit")).otherwise(ids("_all"))
    m = m.select(*on, found.alias("candidates"), outcome.alias("outcome"))
    if keep is not None:
        m = m.select(*on, *[c.alias(name) for name, c in keep.items()], "outcome")
    return join_alike(mentions, m, on)


def mention_candidates(names: DataFrame, met: DataFrame, people: DataFrame, key: str = "mention_id", listed: str = "candidates", who: Column | None = None) -> DataFrame:
    """The mentions that could be meant by names (``normalized``) to which a claim gives no person.

    ``met`` has the rows of ``meet`` with ``key`` and ``surface``.  Returns ``normalized``, ``key``, ``surface, candidates, status, reason``:
    mentions without a person, or with several, under their own name and the others under their person's, without a
    surface.  Rows are listed once for each distinct name, whoever asks for it; sort by ``key`` within a name for the reference order.
    ``met`` may have a column ``listed`` instead of ``candidates`` and, as ``who``, the person of a resolved mention.
    """
    asked = names.where("normalized <> ''").select("normalized").distinct()
    several = F.col("outcome") == "multiple_matching_people"
    open_ = met.where("outcome <> 'resolved'").select("normalized", key, "surface", listed, F.when(several, "ambiguous").otherwise("unresolved").alias("status"), F.col("outcome").alias("reason"))
    person = people.select(F.col("person_id").alias("_pid"), T.normalize_name(F.col("normalized")).alias("normalized"))
    settled = met.where("outcome = 'resolved'").select(key, listed, (F.element_at("candidates", 1) if who is None else who).alias("_pid")).join(person, "_pid")
    settled = settled.select("normalized", key, F.lit(None).cast("string").alias("surface"), listed, F.lit("resolved").alias("status"), F.lit("normalized_name_match").alias("reason"))
    return open_.unionByName(settled).join(asked, "normalized", "left_semi")


#: First words of forms, each with the lengths that such forms have, that are told to every task at most.
STARTS = 10_000


def _phrases(words: Column, size: int, first: list[str] | None) -> Column:
    """All phrases of ``size`` words; with ``first``, of those that begin with one of these."""
    starts = F.when(F.size(words) >= size, F.sequence(F.lit(1), F.size(words) - size + 1)).otherwise(F.array().cast("array<int>"))
    if first is not None:
        starts = F.filter(starts, lambda i: F.element_at(words, i).isin(first))
    return F.transform(starts, lambda i: F.array_join(F.slice(words, i, size), " "))


#: First words that one regular expression names at most.
NAMED_STARTS = 64


def _found(text: Column, size: int, first: list[str] | None) -> Column:
    """All phrases of ``size`` words of a normalized text with a space before it, which may overlap; with ``first``, of those that begin with one of these."""
    start = "[^ ]+" if first is None else f"(?:{'|'.join(sorted(first))})"
    return F.regexp_extract_all(text, F.lit(f"(?= ({start}(?: [^ ]+){{{size - 1}}})(?![^ ]))"), F.lit(1))


def resolve_questions(questions: DataFrame, people: DataFrame, surfaces: DataFrame | None = None, key: str = "question_id", text: str = "question", unique: bool = False) -> DataFrame:
    """Whom each question is about: ``key, person_id, name, matched_text, confidence, intent``; a row only for questions that name someone.

    The form of most words wins, then the last in order of code points, then the smallest person id.  A question's phrases are
    as many as its words times the lengths that forms have, which are gathered first: L different ones need forms of L * L / 2 words
    in all.  Where forms have few first words (``STARTS``), phrases that begin with another are not made.  Questions with
    the same phrases are answered once.  Of repeated keys one row is returned; ``unique`` says that there are none, so that
    answers need not be brought together by key.  A null text names nobody.
    """
    n = F.size(F.split("variant", " "))
    known = forms(people, surfaces).groupBy("variant").agg(F.min("person_id").alias("person_id")).withColumn("n", n)
    begun = cut(known.select("n", F.substring_index("variant", " ", 1).alias("first")).distinct())
    lengths = sorted(r.n for r in begun.select("n").distinct().collect())
    told_first = begun.limit(STARTS + 1).collect()
    first = {size: None if len(told_first) > STARTS else [r["first"] for r in told_first if r.n == size] for size in lengths}
    starts = None if len(told_first) > STARTS else sorted({r["first"] for r in told_first})
    few_starts = starts is not None and len(starts) <= NAMED_STARTS
    told = questions.select(key, F.concat(F.lit(" "), T.normalize_name(F.col(text))).alias("_s")).withColumn("_t", F.split(F.trim("_s"), " "))
    if starts is None or few_starts:
        phrases = [_found(F.col("_s"), size, first[size]) for size in lengths]
    else:
        phrases = [_phrases(F.col("_t"), size, first[size]) for size in lengths]
    # Kept, as both uses would make it anew; filtered only then, as a filter would be pushed below what it is made of and make that once more.
    asked = stored(told.select(key, T.intent_of(F.col("_t")).alias("intent"), F.concat_ws("|", *phrases).alias("line"))).where("line <> ''")
    named = people.select("person_id", "name").dropDuplicates(["person_id"])
    said = asked.select("line").distinct().select("line", F.array_distinct(F.split("line", "[|]")).alias("said")).select("line", F.explode("said").alias("variant"))
    best = said.join(known.join(named, "person_id"), "variant").groupBy("line").agg(F.max(F.struct("n", "variant", "person_id", "name")).alias("b"))
    met = asked.join(best, "line")
    if not unique:
        met = met.groupBy(key).agg(F.max("b").alias("b"), F.min("intent").alias("intent"))
    score = F.lit(0.7) + F.least(F.lit(0.25), F.lit(0.04) * F.col("b.n"))
    return met.select(key, F.col("b.person_id").alias("person_id"), F.coalesce("b.name", "b.person_id").alias("name"), F.col("b.variant").alias("matched_text"), score.alias("confidence"), "intent")
