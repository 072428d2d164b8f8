"""The corpus pipeline: five stages, each of which takes ``(spark, docs, sf_dir)`` and returns a DataFrame.

All but the last return the columns of ``documents``; a driver may write every
stage's rows as Parquet and hand the reread rows to the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from heirloom.cut import cut
from heirloom.llm import langid, minhash, mixing, pieces, suffix_dedup
from heirloom.llm.common import BATCH_BYTES, bound_batches

#: Share of the likeliest language below which a text counts as no language.
LEAST_SCORE = 0.5
#: Bytes of code points whose lattices a worker holds at once, half of what op9 takes: other stages have filled the executors before.
LATTICE_BYTES = 1 << 18

#: The columns that stages read or change; all others pass through them untouched.
KNOWN = ("doc_id", "text", "lang", "source", "n_chars")


def aside(docs: DataFrame) -> tuple[DataFrame, list[str]]:
    """``docs`` with all columns but the known ones under working names that no operator uses, and the names in order."""
    names = [c if c in KNOWN else f"_user{i}" for i, c in enumerate(docs.columns)]
    return docs.toDF(*names), names


def back(found: DataFrame, names: list[str], docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` under their own names and in their order."""
    return found.select(*names).toDF(*docs.columns)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without a recognisable language; fill in the language where it is null.

    Null and empty texts, and texts without letters, go.  Rows are judged one by one, so repeated rows
    and keys stay or go together with their texts, null keys too.  If no row has a language, all go.  Other columns
    pass through whatever their names; an empty table stays empty.
    """
    bound_batches(spark, BATCH_BYTES)
    d, names = aside(docs)
    found = langid.identify(d, langid.train(d))
    clean = found.where((F.col("lang_pred") != "und") & (F.col("score") >= LEAST_SCORE))
    return back(clean.withColumn("lang", F.coalesce("lang", "lang_pred")), names, docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near-duplicates: five-word shingles, similarity 0.8 or more.

    Of rows that share a key, the one whose text comes first stays (null last, and of equal rows any one); rows without a key
    all stay.  Null and empty texts have no duplicates.  Other columns pass through whatever their names; an
    empty table stays empty.
    """
    bound_batches(spark, BATCH_BYTES)
    d, names = aside(docs)
    found = minhash.near_duplicates(d, words=5, percent=80)
    lost = found.where(~F.col("kept")).select("doc_id").distinct()
    few = lost.count() <= minhash.BROADCAST_IDS
    kept = d.join(F.broadcast(lost) if few else lost, "doc_id", "left_anti")
    twice = found.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").limit(1).count()
    if twice:
        place = F.row_number().over(Window.partitionBy("doc_id").orderBy(F.col("text").asc_nulls_last()))
        kept = kept.withColumn("_place", place).where("doc_id is null or _place = 1")
    return back(kept, names, docs)


def suffix_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Remove every stretch of 50 bytes or more that an earlier document has, and correct ``n_chars``.

    A null text becomes an empty one.  A null key comes after all keys; rows that share a key take nothing
    from each other.  Every row stays, repeated ones too.  Other columns pass through whatever their
    names; an empty table stays empty.
    """
    bound_batches(spark, BATCH_BYTES)
    d, names = aside(docs)
    carry = tuple(c for c in names if c not in ("text", "n_chars"))
    found = suffix_dedup.remove_repeats(d, carry=carry, as_text=True)
    return back(found.withColumns({"text": F.col("kept"), "n_chars": F.length("kept").cast("long")}), names, docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat or leave out documents so that the sources' words come near their targets.

    Rows with a null source are one source.  Null and empty texts have size 0 and come first in their source's order; they are repeated
    like others.  Null keys come last among rows of their size; of repeated rows each has its own copies.  Other
    columns pass through whatever their names; an empty table stays empty.
    """
    bound_batches(spark, BATCH_BYTES)
    d, names = aside(docs)
    return back(mixing.emit_copies(mixing.mix_to_targets(mixing.with_size(d, size="_size"), size="_size")), names, docs)


def sample_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sampled SentencePiece ids of every row, decoded again to show that nothing is lost.

    A null text counts as empty.  One row for each row of ``docs``, repeated ones and those with a null key too; other columns
    are not read.  An empty table stays empty.
    """
    bound_batches(spark, BATCH_BYTES)
    v = pieces.load_vocabulary()
    found = pieces.round_trip(docs, v, held=LATTICE_BYTES)
    return found.select("doc_id", "pieces", F.size("pieces").cast("long").alias("n_pieces"), F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("suffix_repeats", suffix_repeats),
    ("mix_sources", mix_sources),
    ("sample_pieces", sample_pieces),
]

#: SQL cannot express the stages' hashes and models; tests hold each stage against a plain version, row by row.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; each one's rows are written to the shared folder, as the next one reads them several times."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
