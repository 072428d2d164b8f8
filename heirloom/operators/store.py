"""A keyed store: batches are written in any order, and read as if each row had come in its turn.

A table's state has one row a key, and beside each value the place (batch, number in the batch) of the row that told it.
Merging states keeps the earliest known value, or the latest, or all; it does not matter in which order batches
arrive, whether one arrives twice, or which were compacted together.  So a batch is an append: its state goes to a folder of its
own, and counts once a line in the log names this folder.  A job that breaks off before leaves nothing that is read.  Compaction
names one new folder and those that it replaces in one line.  Replaced folders are not deleted, as someone may be reading them.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from heirloom.functions import text as T
from heirloom.operators import identity

_LOG = "added string, replaced array<string>"


@dataclass(frozen=True)
class Table:
    """Keys, and columns of which the first known value counts, the latest (null too), or the sorted set of all elements."""

    name: str
    keys: tuple[str, ...]
    first: tuple[str, ...] = ()
    last: tuple[str, ...] = ()
    union: tuple[str, ...] = ()


#: What is known of people, by name, year and place; who they are follows from the order (``people``).
PEOPLE = Table("people", ("normalized", "birth_year", "birth_place"), ("name", "death_year", "death_place", "gender"), union=("aliases",))
FAMILIES = Table("families", ("parent_ids",), ("family_type",))
MEDIA = Table("media", ("media_id",), last=("kind", "path", "caption"))
CLAIMS = Table("claims", ("claim_id",), ("claim_type", "confidence", "notes"))
EVIDENCES = Table("evidences", ("evidence_id",), last=("chunk_id", "quote"))
#: Edges have no columns but their keys.
LINKS = Table("links", ("kind", "source_id", "target_id", "role"))

_KINDS = {"birth_year": "int", "death_year": "int", "confidence": "double", "parent_ids": "array<string>", "aliases": "array<string>"}


def _merge(state: DataFrame, t: Table) -> DataFrame:
    """One row a key of a state; partial sums carry it, so a key of very many rows costs one row a task."""
    found = [F.min("seen").alias("seen"), *[F.min(c).alias(c) for c in t.first], *[F.max(c).alias(c) for c in t.last]]
    found += [F.array_sort(F.array_distinct(F.flatten(F.collect_set(c)))).alias(c) for c in t.union]
    return state.groupBy(*t.keys).agg(*found)


def _state_of(rows: DataFrame, t: Table, batch: int, number: str) -> DataFrame:
    at = F.struct(F.lit(batch).cast("long").alias("batch"), F.col(number).cast("long").alias("number"))
    value = lambda c: F.col(c) if c in rows.columns else F.lit(None).cast(_KINDS.get(c, "string"))
    told = lambda c: F.struct(at.alias("at"), value(c).alias("x"))
    first = [F.when(value(c).isNotNull(), told(c)).alias(c) for c in t.first]
    return rows.select(*[value(k).alias(k) for k in t.keys], at.alias("seen"), *first, *[told(c).alias(c) for c in t.last], *[value(c).alias(c) for c in t.union])


def _log(spark: SparkSession, folder: str, t: Table) -> list[str]:
    """The folders that count: one line a batch and compaction, so the log is as long as there were writes."""
    try:
        lines = spark.read.schema(_LOG).json(f"{folder}/{t.name}/log").collect()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    gone = {x for r in lines for x in r.replaced or []}
    return sorted({r.added for r in lines} - gone)


def _commit(state: DataFrame, folder: str, t: Table, replaced: list[str]) -> None:
    name = uuid.uuid4().hex
    state.write.parquet(f"{folder}/{t.name}/{name}")
    state.sparkSession.createDataFrame([(name, replaced)], _LOG).coalesce(1).write.mode("append").json(f"{folder}/{t.name}/log")


def upsert(rows: DataFrame, folder: str, t: Table, batch: int, number: str = "number") -> None:
    """Write a batch of ``rows`` to table ``t`` of the store in ``folder``, a folder that all executors share.

    ``number`` orders the rows of the batch; batches follow one another by ``batch``, whenever they are written.  Rows of one place
    must be equal; otherwise the least value counts (of ``last``, the greatest).  Columns of the table that ``rows`` lacks are unknown, others are
    left out.  Null keys are keys of their own.  A batch that is written again, as after a failure, changes nothing.
    """
    _commit(_merge(_state_of(rows, t, batch, number), t), folder, t, [])


def compact(spark: SparkSession, folder: str, t: Table) -> None:
    """Merge what the log names into one folder; batches that come meanwhile stay beside it."""
    old = _log(spark, folder, t)
    if len(old) > 1:
        _commit(_state(spark, folder, t, old), folder, t, old)


def _state(spark: SparkSession, folder: str, t: Table, parts: list[str] | None = None) -> DataFrame:
    parts = _log(spark, folder, t) if parts is None else parts
    if not parts:
        raise LookupError(f"nothing was written to {t.name} in {folder}")
    return _merge(spark.read.parquet(*[f"{folder}/{t.name}/{p}" for p in parts]), t)


def read(spark: SparkSession, folder: str, t: Table) -> DataFrame:
    """The keys and columns of ``t``, one row a key; raises ``LookupError`` if no batch was written."""
    s = _state(spark, folder, t)
    return s.select(*t.keys, *[F.col(f"{c}.x").alias(c) for c in (*t.first, *t.last)], *t.union)


def upsert_people(mentions: DataFrame, folder: str, batch: int, number: str = "number") -> None:
    """Write mentions of people, ``name, birth_year, birth_place`` and what else is known, as ``PEOPLE`` has it."""
    place = T.normalize_place(F.col("birth_place")) if "birth_place" in mentions.columns else F.lit(None).cast("string")
    upsert(mentions.withColumns({"normalized": T.normalize_name(F.col("name")), "birth_place": place}), folder, PEOPLE, batch, number)


def people(spark: SparkSession, folder: str) -> DataFrame:
    """The people of all mentions written so far, folded in order (``identity.fold_people``).

    A pair of year and place goes where its first mention went, so the state keeps all that the fold needs: each
    known value stands for one mention, at the place where it was told.
    """
    s = _state(spark, folder, PEOPLE)
    extra = [c for c in PEOPLE.first if c != "name"]
    name = F.col("name.x").alias("name")
    none = {c: F.lit(None).cast(_KINDS.get(c, "string")) for c in extra}
    row = lambda at, known: F.struct(at.alias("at"), *[(F.col(f"{c}.x") if c == known else none[c]).alias(c) for c in extra], (F.col("aliases") if known is None else F.lit(None).cast("array<string>")).alias("aliases"))
    told = F.array_compact(F.array(row(F.col("seen"), None), *[F.when(F.col(c).isNotNull(), row(F.col(f"{c}.at"), c)) for c in extra]))
    m = s.select(*PEOPLE.keys, name, F.explode(told).alias("r")).select(*PEOPLE.keys, "name", "r.at.*", *[f"r.{c}" for c in (*extra, "aliases")])
    return identity.fold_people(m, ("batch", "number"))
