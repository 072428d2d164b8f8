"""Mixing sources to target weights by systematic sampling.

Every source gets a target number of words; a document's expected copies are
``target / source size``.  Within a source the expected copies are summed along
the order (size, cell, key), one random offset is added, and a document is emitted
once per integer that its stretch of the sum crosses.  Ordering by size keeps
the words taken within about half of the largest document of the target.

No group is collected: the place of a row comes from counts of cells
(source, size, hash of the key) plus its place within one cell, so that a source
or a size that holds most rows is spread over as many tasks as there are cells.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from heirloom.llm.common import WORD, column, spare

#: Rows that one cell, a hash range of the keys, holds over all sources and sizes.
CELL_ROWS = 50_000


def with_size(docs: DataFrame, text: str = "text", size: str = "size") -> DataFrame:
    """Add the number of words of ``text`` (null: 0)."""
    return docs.withColumn(size, F.coalesce(F.regexp_count(column(text), F.lit(WORD)), F.lit(0)).cast("long"))


def source_targets(
    sized: DataFrame,
    source: str = "source",
    size: str = "size",
    weights: Sequence[float] = (5, 2, 1),
    share: float = 1.5,
    ceiling: float = 2.0,
) -> DataFrame:
    """One row per source: ``source, source_size, target``.

    Sources by code point, null last, take ``weights`` in turn.  Together they
    get ``share`` times all sizes, each at most ``ceiling`` times its own; what
    a source cannot take goes to the others by weight.  With the sources sorted
    by ``ceiling * size / weight``, the full ones form a prefix, so cumulative
    sums find the level at which nobody is above.  The windows run over one row
    per source.  A source without words has target 0.
    """
    s = sized.groupBy(F.col(source).alias("source")).agg(F.sum(size).alias("source_size"))
    turn = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    wheel = F.array(*[F.lit(float(w)) for w in weights])
    s = s.withColumn("w", F.element_at(wheel, (turn % len(weights) + 1).cast("int")))
    s = s.withColumn("cap", F.col("source_size") * F.lit(float(ceiling)))
    order = Window.orderBy((F.col("cap") / F.col("w")), F.col("source").asc_nulls_last())
    before, whole = order.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    s = s.withColumns(
        {
            "all": F.sum("source_size").over(whole) * F.lit(float(share)),
            "used": F.coalesce(F.sum("cap").over(before), F.lit(0.0)),
            "left": F.sum("w").over(whole) - F.coalesce(F.sum("w").over(before), F.lit(0.0)),
        }
    )
    s = s.withColumn("full", (F.col("all") - F.col("used")) >= F.col("cap") / F.col("w") * F.col("left"))
    s = s.withColumns(
        {
            "full_cap": F.sum(F.when(F.col("full"), F.col("cap")).otherwise(0.0)).over(whole),
            "open_w": F.sum(F.when(~F.col("full"), F.col("w")).otherwise(0.0)).over(whole),
        }
    )
    level = (F.col("all") - F.col("full_cap")) / F.when(F.col("open_w") > 0, F.col("open_w"))
    target = F.when(F.col("full"), F.col("cap")).otherwise(F.least(F.col("cap"), level * F.col("w")))
    return s.select("source", "source_size", target.alias("target"))


def source_offset(source: str, seed: int):
    """The random offset in [0, 1) of a source: a function of its name and the seed alone."""
    return _hash32(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(source), F.lit("\u0000null"))))) / F.lit(float(1 << 32))


def _hash32(digest: Column) -> Column:
    """The first 32 bits of a hexadecimal digest."""
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")


def mix_to_targets(
    sized: DataFrame,
    key: str = "doc_id",
    source: str = "source",
    size: str = "size",
    weights: Sequence[float] = (5, 2, 1),
    share: float = 1.5,
    ceiling: float = 2.0,
    seed: int = 17,
) -> DataFrame:
    """Add ``source_size, target, copies, taken`` to every row of ``sized``.

    ``copies`` is how often the mix takes the row, ``taken`` the words of that.
    Columns of the input with these names are replaced; all others pass through.
    Rows with a null source form one source; null sizes count as 0; null keys
    share a cell and come last in it.  Rows that agree in source, size and key
    share the copies of their places in no particular order.  An empty input
    gives an empty result.
    """
    cells = max(1, sized.count() // CELL_ROWS)
    new = {"source_size", "target", "copies", "taken"}
    passed = [c for c in sized.columns if c.lower() not in new]
    src, n, cell, place, start, offset = spare(passed, "_src", "_n", "_cell", "_place", "_start", "_offset")
    group = [src, n, cell]
    d = sized.select(*map(column, passed)).withColumns(
        {
            src: F.coalesce(F.concat(F.lit("s"), column(source)), F.lit("n")),
            n: F.coalesce(column(size), F.lit(0)).cast("long"),
            cell: F.coalesce(_hash32(F.md5(column(key).cast("string"))) % cells, F.lit(0)),
        }
    )
    counted = d.groupBy(*group).agg(F.count(F.lit(1)).alias("rows"))
    sizes = counted.groupBy(src, n).agg(F.sum("rows").alias("rows"))
    by_size = Window.partitionBy(src).orderBy(n).rowsBetween(Window.unboundedPreceding, -1)
    by_cell = Window.partitionBy(src, n).orderBy(cell).rowsBetween(Window.unboundedPreceding, -1)
    lower = sizes.select(src, n, F.coalesce(F.sum("rows").over(by_size), F.lit(0)).alias("below"))
    ahead = counted.select(*group, F.coalesce(F.sum("rows").over(by_cell), F.lit(0)).alias("ahead"))

    t = source_targets(d.select(column(source).alias("source"), F.col(n).alias("size")), "source", "size", weights, share, ceiling)
    t = t.select(
        F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("n")).alias(src),
        "source_size",
        F.coalesce("target", F.lit(0.0)).alias("target"),
        source_offset("source", seed).alias(offset),
    )
    # What a row learns of its source comes with its cell, so that no row is joined by source alone.
    known = ahead.join(lower, [src, n]).join(t, src).select(*group, (F.col("below") + F.col("ahead")).alias(start), "source_size", "target", offset)
    turn = F.row_number().over(Window.partitionBy(*group).orderBy(column(key).asc_nulls_last()))
    d = d.withColumn(place, turn).join(known, group)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    upto = F.floor(F.col(offset) + rate * (F.col(start) + F.col(place)))
    prior = F.floor(F.col(offset) + rate * (F.col(start) + F.col(place) - 1))
    # Rounding could cross one integer too many where the rate is a whole number.
    copies = F.least(upto - prior, F.ceil(rate)).cast("long")
    return d.select(*map(column, passed), "source_size", "target", copies.alias("copies"), (copies * F.col(n)).alias("taken"))


def emit_copies(mixed: DataFrame) -> DataFrame:
    """Repeat every row ``copies`` times."""
    (copy,) = spare(mixed.columns, "_copy")
    return mixed.withColumn(copy, F.explode(F.expr("array_repeat(0, cast(copies as int))"))).drop(copy)
