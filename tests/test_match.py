"""Texts without tokens, and texts that are not there, against the SQL."""

import hashlib

import duckdb
from pyspark.sql import functions as F

from heirloom.functions import text as T
from heirloom.plans import registry


def test_texts_without_tokens(spark, tmp_path):
    texts = [None, "", " \n", "!? —", "ΣΑ", "Ёлка, Elk 7", "İx", "a"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(tuple(r) for r in registry.QUERIES["fn_match_normalize"](spark, str(tmp_path)).collect())
    with duckdb.connect() as db:
        db.execute(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
        assert got == sorted(db.execute(registry.ORACLE["fn_match_normalize"]).fetchall())
    assert [n for _, n, _ in got][:6] == [None, 0, 0, 0, 0, 3]
    assert got[5][2] == hashlib.md5("елка elk 7".encode()).hexdigest()


def test_null_is_empty_for_the_rules(spark):
    assert spark.range(1).select(T.match_normalize(F.lit(None).cast("string")).alias("t")).first().t == ""
