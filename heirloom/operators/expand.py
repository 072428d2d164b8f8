"""Expansion from one person through claims, breadth first, within bounds of depth and number of tasks.

Tasks are worked off a wave at a time: a wave is what the queue holds, in order,
and all that it adds comes after it, so waves give the same order as one queue.
A wave is a join of the task table with the claims; only counts reach the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from heirloom.cut import cut

TASK = "kind string, subject string, depth int, pos long"


def _task(kind: str, subject: Column, depth: Column) -> Column:
    return F.struct(F.lit(kind).alias("kind"), subject.alias("subject"), depth.cast("int").alias("depth"))


def family_id(a: Column, b: Column) -> Column:
    """The family of two people, in either order."""
    return F.concat(F.lit("family-"), F.md5(F.concat_ws(",", F.least(a, b), F.greatest(a, b))))


def _follow_ups(profiles: bool, descendants: bool) -> Column:
    """The tasks that a claim's row adds, in order."""
    here, next_ = F.col("depth"), F.col("depth") + 1
    child, p1, p2 = F.col("p1"), F.col("p2"), F.col("p3")
    family = F.when(F.col("fid").isNotNull(), _task("find_children", F.col("fid"), here))

    def of_parent(p: Column) -> list[Column]:
        own = [family, _task("find_parents", p, next_)]
        own += [_task("find_profile", p, next_), _task("find_profile", child, next_)] if profiles else []
        own += [_task("find_spouses", child, next_)] if descendants else []
        return [F.when(p.isNotNull(), x) for x in own]

    couple = [_task("find_children", F.col("fid"), next_), _task("find_parents", child, next_), _task("find_parents", p1, next_)]
    couple += [_task("find_profile", child, next_), _task("find_profile", p1, next_)] if profiles else []
    kind = F.col("claim_type")
    empty = F.array_compact(F.array(F.when(F.lit(False), couple[0])))
    return F.when(kind == "parent_child", F.array_compact(F.array(*of_parent(p1), *of_parent(p2)))).when(kind == "spouse", F.array_compact(F.array(*couple))).otherwise(empty)


def expand(claims: DataFrame, seed: str, max_depth: int = 3, max_tasks: int = 100, profiles: bool = True, descendants: bool = True) -> tuple[DataFrame, DataFrame]:
    """The tasks run, ``kind, subject, depth, pos`` in order, and the claims that they applied.

    ``claims`` answers tasks: ``task_type, subject, claim_no, claim_type, p1, p2, p3``
    with the child and up to two parents, or the two spouses; people and families
    (``family_id``) are given by id.  The first time that a task is queued fixes
    its depth; a claim without a first person, and a spouse claim without a second,
    is not applied.  Tasks for unknown subjects do nothing but count.
    """
    spark = claims.sparkSession
    fid = F.when(F.col("p2").isNotNull() & F.coalesce("p3", F.when(F.col("claim_type") == "spouse", F.col("p1"))).isNotNull(), F.when(F.col("claim_type") == "spouse", family_id(F.col("p1"), F.col("p2"))).otherwise(family_id(F.col("p2"), F.col("p3"))))
    usable = claims.where("p1 is not null and (claim_type <> 'spouse' or p2 is not null)").withColumn("fid", fid)
    first = [("find_parents", seed, 0, 0)] + ([("find_profile", seed, 0, 1)] if profiles else [])
    wave = cut(spark.createDataFrame(first, TASK))
    done, applied, left, at = wave.where("false"), None, max_tasks, 0
    while left > 0:
        # At most max_tasks rows, so that one task may number them.
        wave = cut(wave.orderBy("pos").limit(left))
        n = wave.count()
        if not n:
            break
        hit = wave.join(usable.withColumnRenamed("task_type", "kind"), ["kind", "subject"])
        rows = cut(hit.withColumn("adds", _follow_ups(profiles, descendants)))
        applied = rows if applied is None else applied.unionByName(rows)
        seen = cut(done.unionByName(wave))
        new = rows.select("pos", "claim_no", F.posexplode("adds").alias("i", "t")).where(F.col("t.depth") <= max_depth).select("t.*", F.struct("pos", "claim_no", "i").alias("o"))
        new = new.groupBy("kind", "subject").agg(F.min("o").alias("o"), F.min_by("depth", "o").alias("depth")).join(seen.select("kind", "subject"), ["kind", "subject"], "left_anti")
        left, at, done = left - n, at + n, seen
        new = new.orderBy("o").limit(max(left, 0))
        wave = new.select("kind", "subject", "depth", (F.row_number().over(Window.orderBy("o")) + at - 1).cast("long").alias("pos"))
    keep = ["claim_type", "p1", "p2", "p3", "fid"]
    out = applied.select("pos", "claim_no", *keep) if applied is not None else usable.where("false").select(F.lit(0).cast("long").alias("pos"), "claim_no", *keep)
    return done, out


def summary(tasks: DataFrame, applied: DataFrame, seed: str) -> DataFrame:
    """``tasks_run, claims_written, people, families``: one row."""
    found = applied.select(F.explode(F.array_compact(F.array("p1", "p2", "p3"))).alias("id")).union(applied.sparkSession.createDataFrame([(seed,)], "id string"))
    return tasks.agg(F.count(F.lit(1)).alias("tasks_run")).crossJoin(applied.agg(F.count(F.lit(1)).alias("claims_written"), F.count_distinct("fid").alias("families"))).crossJoin(found.agg(F.count_distinct("id").alias("people")))
