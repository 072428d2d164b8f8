"""Numbering rows along an order without sorting them in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from heirloom.cut import cut


def numbered(df: DataFrame, key: str, name: str) -> DataFrame:
    """``df`` with whole numbers from 1 that follow ``key``: sorted ranges, numbered within, behind the sizes of those before.

    Rows of one key follow one another in no particular order.
    """
    ranges = cut(df.repartitionByRange(key).withColumn("_part", F.spark_partition_id()))
    # One row per range.
    sizes = ranges.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    ahead = sizes.select("_part", F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_ahead"))
    within = F.row_number().over(Window.partitionBy("_part").orderBy(key))
    return ranges.withColumn(name, within).join(F.broadcast(ahead), "_part").withColumn(name, (F.col(name) + F.col("_ahead")).cast("long")).drop("_part", "_ahead")
