"""JSON files that hold one array, however long, read by many tasks.

Spark's text reader cuts the files at closing braces, so a file is split into byte
ranges like any other text.  Where a piece lies in its document depends on all that
comes before it; that is put together from what each range does on its own:

* Unescaped quotes turn "inside a string" on and off.  Their number in every
  range, summed over the ranges before, says how a range begins.
* Then brackets outside strings count, and the sums say how deep it begins.

Both sums run over one row a range, and over the pieces within a range.  A piece
that closes a brace at depth 1 ends an item; the pieces of an item meet by its number.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: An escape, and a whole string or the beginning of one that the piece does not end.
_ESCAPE, _STRING = r"\\.", '"[^"]*("|$)'
_RANGE = ("file", "block")


def _within(*keys: str) -> Window:
    return Window.partitionBy(*_RANGE, *keys).orderBy("no").rowsBetween(Window.unboundedPreceding, Window.currentRow)


def _before_block(value: str) -> Column:
    """The sum of ``value`` over the ranges of a file before this one: one row a range."""
    over = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(value).over(over), F.lit(0))


def _pieces(spark: SparkSession, paths: list[str], glob: str | None) -> DataFrame:
    """``file, size, block, no, piece``: the text between closing braces, numbered along each range."""
    reader = spark.read.option("lineSep", "}").option("recursiveFileLookup", True)
    raw = (reader.option("pathGlobFilter", glob) if glob else reader).text(paths)
    m = F.col("_metadata")
    return raw.select(m["file_path"].alias("file"), m["file_size"].alias("size"), m["file_block_start"].alias("block"), F.monotonically_increasing_id().alias("no"), F.col("value").alias("piece"))


def _brackets(inside: Column, piece: Column) -> Column:
    """The opening brackets and closing square brackets of a piece that are in no string."""
    return F.regexp_replace(F.regexp_replace(F.when(inside, F.concat(F.lit('"'), piece)).otherwise(piece), _STRING, ""), r"[^\[\]{]+", "")


def _walk(brackets: Column) -> Column:
    """``inner, low``: how much deeper brackets lead, and the least depth behind any of them; null without brackets."""
    start = F.struct(F.lit(0).cast("long").alias("inner"), F.lit(None).cast("long").alias("low"))

    def step(acc: Column, x: Column) -> Column:
        now = acc["inner"] + F.when(x == "]", -1).when(x == "", 0).otherwise(1)
        return F.struct(now.alias("inner"), F.when(x == "", acc["low"]).otherwise(F.least(acc["low"], now)).alias("low"))

    return F.aggregate(F.split(brackets, ""), start, step)


def array_items(spark: SparkSession, paths: str | list[str], glob: str | None = None) -> DataFrame:
    """``file, pos, item``: every object that is a direct item of a file's array, as JSON text, by its place among these.

    Items that are no objects are skipped.  Blank files have no items.  A file that holds something else than an
    array, or whose array breaks off, fails the query; a missing last bracket alone is forgiven, and what follows
    the bracket is not read.  Items are not checked here: a broken one fails where it is parsed.
    """
    p = _pieces(spark, [paths] if isinstance(paths, str) else paths, glob)
    p = p.withColumn("bare", F.regexp_replace("piece", f"(?s){_ESCAPE}", ""))
    p = p.withColumn("quotes", (F.octet_length("bare") - F.octet_length(F.replace("bare", F.lit('"'), F.lit("")))).cast("long"))
    sums = p.groupBy(*_RANGE).agg(F.sum("quotes").alias("quotes"), F.sum(F.octet_length("piece") + 1).alias("bytes"), F.max("size").alias("size"))
    last = Window.partitionBy("file").orderBy("block").rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = Window.partitionBy("file")
    # The text reader does not tell whether the last piece ended in a brace; the number of bytes does.
    blocks = sums.select(*_RANGE, (_before_block("quotes") % 2).alias("odd"), (F.max("block").over(last) == F.col("block")).alias("end"), (F.sum("bytes").over(whole) == F.col("size")).alias("braced"))
    p = p.join(blocks, list(_RANGE))
    p = p.withColumn("until", F.sum("quotes").over(_within()) + F.col("odd"))
    p = p.withColumns({"inside": (F.col("until") - F.col("quotes")) % 2 == 1, "last": F.col("end") & F.lead("no").over(Window.partitionBy(*_RANGE).orderBy("no")).isNull()})
    closes = (F.col("until") % 2 == 0) & (~F.col("last") | F.col("braced"))
    p = p.withColumns({"closes": closes, "walk": _walk(_brackets(F.col("inside"), F.col("bare")))}).withColumn("step", F.col("walk.inner") - F.col("closes").cast("long"))
    p = p.select(*_RANGE, "no", "piece", "last", "braced", "closes", F.col("walk.low").alias("low"), "step", F.sum("step").over(_within()).alias("depth"))
    depths = p.groupBy(*_RANGE).agg(F.sum("step").alias("step")).select(*_RANGE, _before_block("step").alias("base"))
    p = p.join(depths, list(_RANGE)).withColumns({"depth": F.col("depth") + F.col("base")})
    # The array ends with the first piece in which a bracket leads back to depth 0: what comes after it is not read.
    over = F.coalesce(F.col("depth") - F.col("step") + F.col("low") <= 0, F.lit(False))
    p = p.withColumns({"ends": (F.col("closes") & (F.col("depth") == 1) & ~over).cast("long"), "over": over.cast("long")})
    p = p.withColumns({"n_ends": F.sum("ends").over(_within()), "n_over": F.sum("over").over(_within())})
    counts = p.groupBy(*_RANGE).agg(F.sum("ends").alias("e"), F.sum("over").alias("o")).select(*_RANGE, _before_block("e").alias("e"), _before_block("o").alias("o"))
    p = p.join(counts, list(_RANGE)).where(F.col("n_over") + F.col("o") - F.col("over") == 0)
    item = (F.col("n_ends") + F.col("e") - F.col("ends")).alias("pos")
    pieces = F.transform(F.array_sort(F.collect_list(F.struct("block", "no", "piece"))), lambda x: x["piece"])
    grouped = p.groupBy("file", item).agg(F.array_join(pieces, "}").alias("text"), F.max("ends").alias("ends"), F.max("over").alias("over"), F.max(F.col("last") & ~F.col("braced")).alias("open"), F.max("last").alias("last"))
    trimmed = F.regexp_replace("text", r"^[\s]+", "")
    begins = F.when((F.col("pos") == 0) & (trimmed != "") & ~trimmed.startswith("["), F.raise_error(F.concat(F.lit("no JSON array: "), F.col("file")))).otherwise(F.lit(True))
    # What is left behind the last item: other items and the closing bracket, or nothing.
    rest = F.regexp_replace(trimmed, r"^\[|[\s,]+", "")
    sound = (F.col("ends") == 1) | (F.col("over") == 1) | (rest == "")
    checked = grouped.where(begins).where(F.when(sound, F.lit(True)).otherwise(F.raise_error(F.concat(F.lit("no JSON array, it breaks off: "), F.col("file")))))
    return checked.where("ends = 1").select("file", "pos", F.concat("text", F.lit("}")).alias("text")).select("file", "pos", _last_object(F.col("text")).alias("item"))


def _last_object(text: Column) -> Column:
    """The item that ends a group of pieces, without the bracket, commas and other items before it."""
    lean = F.regexp_replace(text, r"^\s*\[?[\s,]*", "")
    # Nearly always the object is all that is left; otherwise the group is an array's inside, and its last item is meant.
    alone = lean.startswith("{")
    other = F.to_json(F.element_at(F.try_variant_get(F.parse_json(F.concat(F.lit("["), lean, F.lit("]"))), "$", "array<variant>"), -1))
    return F.when(alone, lean).otherwise(other)
