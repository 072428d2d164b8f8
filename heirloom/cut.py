"""Cutting lineage in a folder that every executor shares."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Used only on one machine, as in tests, where the session names no folder.
LOCAL_DEFAULT = "/tmp/checkpoints/heirloom"


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The checkpoint folder of the session: what ``spark.checkpoint.dir`` names; in local mode alone a default of its own."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and sc.master.split("[")[0] != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(named or LOCAL_DEFAULT)
    return sc.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and go on from the written rows.

    A reliable checkpoint survives the loss of any executor, unlike a local one.
    The rows are wrapped anew because a checkpoint keeps the size estimate of the
    plan that made it: in loops these products of products grow without bound,
    until the planner spends its time multiplying them.
    """
    ensure_checkpoint_dir(df.sparkSession)
    kept = df.checkpoint(eager=True)._jdf
    fresh = df.sparkSession._jsparkSession.internalCreateDataFrame(kept.queryExecution().toRdd(), kept.schema(), False)
    return DataFrame(fresh, df.sparkSession)


#: Rows of a few narrow columns that one task takes at least, where they are counted.
ROWS_EACH = 100_000


def gathered(df: DataFrame, each: int = ROWS_EACH) -> tuple[DataFrame, int]:
    """``cut``, and the number of rows; they lie in no more partitions than ``each`` rows apiece fill, so that later steps over few rows are few tasks."""
    kept = cut(df)
    n = kept.coalesce(kept.sparkSession.sparkContext.defaultParallelism).count()
    return kept.coalesce(max(1, -(-n // each))), n


#: Names or ids that are told to every task at most; beyond, rows travel to them.
TOLD = 200_000


def few(df: DataFrame, most: int = TOLD) -> DataFrame:
    """``cut`` for one side of a join, short names or ids: broadcast if it has at most ``most`` rows, so that the other side stays where it is."""
    kept = cut(df)
    return F.broadcast(kept) if kept.limit(most + 1).count() <= most else kept


def stored(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet below the checkpoint folder and read it back: for wide rows, of which later reads take a few columns."""
    folder = f"{ensure_checkpoint_dir(df.sparkSession)}/stored-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)
