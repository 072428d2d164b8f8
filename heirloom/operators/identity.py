"""Who is who, where places count: the fold of mentions into people in claim order.

A mention belongs to the first person of its name whose known birth year and
known birth place do not contradict its own, and lends that person what it
knows; otherwise it begins a new one.  Order matters, so there is no closed form once
places are known.  But a mention with the same year and place as an earlier one always goes where
that one went: whoever stood before it still contradicts, and the person itself has only learned
what the two agree on.  So each name is folded over its distinct (year, place) pairs in order of first
appearance, however many mentions they stand for, and everything else is grouped sums.
"""

from __future__ import annotations

import heapq
from collections import defaultdict

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SEQ = ("k", "pattern_no", "match_no", "role")


def fold_pairs(pairs: list[tuple[int | None, str | None]]) -> list[int]:
    """The person, numbered in order of appearance, of each (year, place) pair of one name, in order.

    People are found by what they know: at most four kinds of knowledge agree with a pair, and
    each kind has a heap of its people, so that a name of many people takes little more than a step a pair.
    """
    known: list[tuple[int | None, str | None]] = []
    by_both, by_year, by_place = (defaultdict(list) for _ in range(3))

    def learn(i: int, now: tuple[int | None, str | None]) -> None:
        for heap in (by_both[now], by_year[now[0]], by_place[now[1]]):
            heapq.heappush(heap, i)

    def first(heaps: list[list[int]], holds) -> int | None:
        least = None
        for h in heaps:
            while h and not holds(h[0]):  # a person that has learned since stands elsewhere now
                heapq.heappop(h)
            if h and (least is None or h[0] < least):
                least = h[0]
        return least

    out = []
    for year, place in pairs:
        if year is None and place is None:
            i = 0 if known else None
        elif place is None:
            i = first([by_year[year], by_year[None]], lambda i: known[i][0] in (year, None))  # noqa: B023
        elif year is None:
            i = first([by_place[place], by_place[None]], lambda i: known[i][1] in (place, None))  # noqa: B023
        else:
            keys = [(y, p) for y in (year, None) for p in (place, None)]
            i = first([by_both[x] for x in keys], lambda i: known[i] in keys)  # noqa: B023
        if i is None:
            i = len(known)
            known.append((year, place))
            learn(i, (year, place))
        else:
            now = (year if known[i][0] is None else known[i][0], place if known[i][1] is None else known[i][1])
            if now != known[i]:
                known[i] = now
                learn(i, now)
        out.append(i)
    return out


def _fold(name: pd.DataFrame) -> pd.DataFrame:
    name = name.sort_values("rank", kind="stable")
    years = [None if pd.isna(y) else int(y) for y in name["year"]]
    places = [None if p is None or p != p else p for p in name["place"]]
    return name.assign(person=fold_pairs(list(zip(years, places, strict=True))))[["normalized", "year", "place", "person"]]


def fold_people(mentions: DataFrame, seq: tuple[str, ...] = SEQ) -> DataFrame:
    """People of mentions ``name, normalized, birth_year, death_year, birth_place`` and, where there are any, ``death_place, gender, aliases``.

    Returns ``person_id, name, normalized, birth_year, birth_place, death_year`` and these, by the first
    mention that knows each; ``aliases`` are the sorted set of all.  Names without any known place have a closed form (first
    year of the name for mentions without one), which needs no fold.  Years and places are compared as they are: normalise before.
    Mentions must differ in ``seq``; a null name is a name of its own.
    """
    order = F.struct(*seq)
    extra = [c for c in ("death_place", "gender") if c in mentions.columns]
    aliases = "aliases" in mentions.columns
    parts = [F.min_by("name", order).alias("name"), F.min(order).alias("seen"), *[F.min(F.when(F.col(c).isNotNull(), F.struct(order.alias("at"), F.col(c).alias("x")))).alias(c) for c in ("death_year", *extra)]]
    if aliases:
        parts.append(F.flatten(F.collect_set("aliases")).alias("aliases"))
    # One row for each distinct pair of a name: partial sums carry it, so a common name costs a row a pair and task.
    pairs = mentions.groupBy("normalized", F.col("birth_year").alias("year"), F.col("birth_place").alias("place")).agg(*parts)
    placed = pairs.groupBy("normalized").agg(F.max(F.col("place").isNotNull()).alias("placed"), F.min_by("year", F.when(F.col("year").isNotNull(), F.col("seen"))).alias("first_year"))
    pairs = pairs.join(placed.withColumnRenamed("normalized", "_n"), F.col("normalized").eqNullSafe(F.col("_n"))).drop("_n")
    simple = pairs.where("not placed").withColumn("who", F.coalesce(F.col("year"), F.col("first_year"), F.lit(-1)).cast("long"))
    hard = pairs.where("placed")
    ranked = hard.select("normalized", "year", "place", F.row_number().over(Window.partitionBy("normalized").orderBy("seen")).alias("rank"))
    kinds = dict(pairs.dtypes)
    folded = ranked.groupBy("normalized").applyInPandas(_fold, f"normalized string, year {kinds['year']}, place string, person long")
    folded = folded.toDF("_n", "_y", "_p", "who")
    same = F.col("normalized").eqNullSafe(F.col("_n")) & F.col("year").eqNullSafe(F.col("_y")) & F.col("place").eqNullSafe(F.col("_p"))
    hard = hard.join(folded, same).drop("_n", "_y", "_p")
    every = simple.unionByName(hard)
    first = lambda c: F.min(c)["x"].alias(c)
    by_seen = lambda c: F.min_by(c, F.when(F.col(c).isNotNull(), F.col("seen")))
    people = every.groupBy("normalized", "who").agg(
        F.min_by("name", "seen").alias("name"), by_seen("year").alias("birth_year"), by_seen("place").alias("birth_place"), *[first(c) for c in ("death_year", *extra)],
        *([F.array_sort(F.array_distinct(F.flatten(F.collect_list("aliases")))).alias("aliases")] if aliases else []), F.min("seen").alias("seen"),
    )
    rank = F.row_number().over(Window.partitionBy("normalized").orderBy("seen"))
    pid = F.concat(F.lit("person-"), F.substring(F.md5(F.coalesce("normalized", F.lit(""))), 1, 16), F.lit("-"), F.lpad(rank.cast("string"), 4, "0"))
    return people.select(pid.alias("person_id"), "name", "normalized", "birth_year", "birth_place", "death_year", *extra, *(["aliases"] if aliases else []))
