"""What crosses between an executor and its workers is bounded by bytes, not by rows alone."""

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from heirloom.llm import exchange as X
from heirloom.llm import pieces
from heirloom.llm.common import BATCH_BYTES, bound_batches, in_slices

ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


@pytest.fixture
def settings(spark):
    yield spark.conf
    for key in (ROWS, BYTES):
        spark.conf.unset(key)


def sizes(batches):
    for b in batches:
        yield pa.RecordBatch.from_pydict({"n": pa.array([b.nbytes], pa.int64())})


def long_texts(spark, n):
    return spark.range(0, n, 1, 1).select(F.col("id").alias("doc_id"), F.repeat(F.lit("long text "), 2000).alias("text"))


def test_batches_of_a_stage_are_bounded_by_bytes(spark, settings):
    docs = long_texts(spark, 500).withColumns({"lang": F.lit("en"), "source": F.lit("s"), "n_chars": F.lit(20_000)})
    corpus_pipeline.sample_pieces(spark, docs, "")
    found = [r.n for r in docs.select("text").mapInArrow(sizes, "n long").collect()]
    assert sum(found) >= 500 * 20_000
    assert max(found) <= 2 * BATCH_BYTES


def test_bounds_are_only_lowered(spark, settings):
    settings.set(BYTES, "64k")
    settings.set(ROWS, "100")
    bound_batches(spark, BATCH_BYTES)
    assert (settings.get(BYTES), settings.get(ROWS)) == ("64k", "100")
    settings.set(BYTES, "3m")
    bound_batches(spark)
    assert settings.get(BYTES) == "3m"
    bound_batches(spark, BATCH_BYTES)
    assert settings.get(BYTES) == str(BATCH_BYTES)


def test_slices_hold_all_rows_in_order():
    whole = pa.table({"i": pa.array(range(50), pa.int64()), "x": pa.array([b"%d" % i * 5000 for i in range(50)], pa.binary())})
    cut = in_slices(whole, 1 << 16)
    assert cut.equals(whole)
    assert 1 < len(cut.to_batches()) <= 50
    assert in_slices(whole.slice(0, 0), 1).equals(whole.slice(0, 0))
    assert in_slices(whole, 1).equals(whole)


def test_what_a_chunk_gives_back_is_whole(spark, settings):
    bound_batches(spark, BATCH_BYTES)
    d, _ = X.chunked(long_texts(spark, 500), "doc_id", "text", ())
    asked = spark.createDataFrame([(0, 0, X.squeeze(b"x"))], X.LETTER)
    found = X.meet(d.withColumn("chunk", F.lit(0)), asked, lambda t, mail: t.select(["key", "text"]), "key long, text string")
    assert sorted(r.key for r in found.where("length(text) = 20000").collect()) == list(range(500))


def test_pieces_do_not_depend_on_what_is_held_at_once():
    v = pieces.load_vocabulary()
    texts = ["Some words, some more words.", None, "", "Ein Satz über Äpfel " * 40, "naïve  spaces\n", "word " * 300]
    few, many = (pieces.sample_pieces(v, texts, [1, 2, 3, None, 5, 6], held=n) for n in (1, 1 << 30))
    assert [x.tolist() for x in few] == [x.tolist() for x in many]
