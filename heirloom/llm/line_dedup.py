"""Line deduplication over whole texts, with DataFrame functions alone.

Every line is known by two 64-bit hashes of its key.  The hashes are dealt out
by equal ranges of the first one (hashes are uniform, so no sampling of range
bounds is needed), and each range is sorted by hash, document and position.
One pass along a range carries the first document of the hash at hand; a line
that comes later, in another document, is dropped.  What travels back is a line's
place, not its text: a document's places become one compressed bitmap of the
lines that it keeps, and the text, read by its own scan, meets that bitmap once.

A line that a large share of documents has would fill one range.  Such hashes
are found in a sample of documents of bounded size; each is cut into ``SPREAD``
groups, the groups' first documents are put together (at most ``HOT_LINES``
rows, broadcast), and a hash that the sample misses only makes its range slower.
The sample decides the way a line goes, never whether it stays.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from heirloom.llm.common import column, spare

#: Code points that a key has at least, to be dropped.
LEAST_CHARS = 10
#: What is stripped from both ends of a line.
BLANKS = "\t\n\x0b\x0c\r "
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Documents of the sample that finds frequent lines.
SAMPLE_DOCS = 20_000
#: A line is frequent if one in so many documents of the sample has it; so many lines are spread at most.
HOT_SHARE, HOT_LINES = 1000, 4096
#: Groups into which a frequent line is cut.
SPREAD = 256


def lines_of(text: Column) -> Column:
    """The lines of a text; null is one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    """A line without blanks at its ends, A-Z in lower case and all other letters as they are."""
    bare = F.btrim(line, F.lit(BLANKS))
    ascii_only = F.octet_length(bare) == F.char_length(bare)
    return F.when(ascii_only, F.lower(bare)).otherwise(F.translate(bare, _UPPER, _LOWER))


def text_hash(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def hashed_lines(docs: DataFrame, least: int = LEAST_CHARS) -> DataFrame:
    """``doc, body, pos, h1, h2`` of every line of ``docs`` (``doc, text``) whose key has ``least`` code points; ``body`` is a hash of the text."""
    # The hash of the text comes first: no text travels beside its lines.
    d = docs.select("doc", text_hash(F.col("text")).alias("body"), "text")
    rows = d.select("doc", "body", F.posexplode(lines_of(F.col("text"))).alias("pos", "line"))
    # Lower case leaves the number of code points as it is.
    long = rows.where(F.char_length(F.btrim("line", F.lit(BLANKS))) >= least)
    keyed = long.select("doc", "body", "pos", line_key(F.col("line")).alias("key"))
    return keyed.select("doc", "body", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(13), F.reverse("key")).alias("h2"))


def frequent_lines(docs: DataFrame, least: int = LEAST_CHARS) -> DataFrame:
    """``h1, h2`` of lines that many documents of a bounded sample have: at most ``HOT_LINES`` rows."""
    n = docs.count()
    some = docs if n <= SAMPLE_DOCS else docs.sample(SAMPLE_DOCS / n, seed=13)
    floor = max(16, min(n, SAMPLE_DOCS) // HOT_SHARE)
    counted = hashed_lines(some, least).groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n"))
    return counted.where(F.col("n") >= floor).orderBy(F.desc("n"), "h1", "h2").limit(HOT_LINES).select("h1", "h2")


def repeated_lines(docs: DataFrame, least: int = LEAST_CHARS) -> DataFrame:
    """``doc, body, pos`` of every line whose key a smaller document has; a null document is larger than all others."""
    ranges = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hot = F.broadcast(frequent_lines(docs, least).withColumn("hot", F.lit(True)))
    salt = F.when(F.col("hot"), 1 + F.pmod(F.xxhash64("doc", "body", "pos"), F.lit(SPREAD))).otherwise(0).cast("int")
    # The top 31 bits of the first hash as a part of ``ranges``; the groups of a frequent line go to ranges of their own.
    place = F.shiftrightunsigned("h1", 33) * ranges
    rows = hashed_lines(docs, least).join(hot, ["h1", "h2"], "left").withColumn("salt", salt)
    rows = rows.withColumn("range", F.pmod(F.shiftrightunsigned(place, 31) + F.col("salt"), F.lit(ranges)).cast("int")).drop("hot")
    dealt = rows.repartitionById(ranges, F.col("range"))
    along = Window.partitionBy("range", "h1", "h2", "salt").orderBy(F.col("doc").asc_nulls_last(), "pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    first = dealt.withColumn("first", F.first("doc").over(along))
    # The frequent lines' rows are summed up where they are read: one row a line and task moves.
    firsts = rows.where("salt > 0").groupBy("h1", "h2").agg(F.min("doc").alias("first_of_all"))
    found = first.join(F.broadcast(firsts), ["h1", "h2"], "left")
    first_doc = F.coalesce("first_of_all", "first")
    return found.where(first_doc.isNotNull() & (F.col("doc").isNull() | (F.col("doc") > first_doc))).select("doc", "body", "pos")


def line_bitmaps(docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = LEAST_CHARS) -> DataFrame:
    """``doc, body, n_dropped, keep`` of every document that loses lines; ``keep`` is its compressed bitmap.

    A bitmap begins with lines that stay and holds, ascending, the numbers of
    the lines at which staying turns into dropping and back.

    Rows are told apart by ``key`` and a hash of their text; rows that agree in
    both have one bitmap.  Rows of one key are one document: they never
    drop lines of one another.  Rows with a null key are one document, after all others.
    """
    d = docs.select(column(key).alias("doc"), column(text).alias("text"))
    sets = repeated_lines(d, least).groupBy("doc", "body").agg(F.array_sort(F.collect_set("pos")).alias("d"))
    begins = F.filter("d", lambda x, i: (i == 0) | (F.get("d", i - 1) != x - 1))
    ends = F.filter("d", lambda x, i: (i == F.size("d") - 1) | (F.get("d", i + 1) != x + 1))
    turns = F.flatten(F.zip_with(begins, ends, lambda a, b: F.array(a, b + 1)))
    return sets.select("doc", "body", F.size("d").cast("long").alias("n_dropped"), turns.alias("keep"))


def drop_repeated_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = LEAST_CHARS) -> DataFrame:
    """Add ``n_lines, n_dropped, keep`` to every row of ``docs``: the compressed bitmap of the lines that stay.

    A line's key is the line without blanks at its ends, A-Z in lower case.
    Keys of at least ``least`` code points that several documents hold lose all
    their lines but those in the document with the smallest key.  ``keep`` is as
    in ``line_bitmaps``, empty where nothing is dropped; ``kept_text`` applies it.

    Null and empty texts are one empty line, which stays.  Null and repeated keys:
    see ``line_bitmaps``.  Repeated rows all come back.  Columns of the input
    named ``n_lines``, ``n_dropped`` or ``keep`` are replaced, all others pass
    through.  An empty input gives an empty result.
    """
    new = {"n_lines", "n_dropped", "keep"}
    passed = [c for c in docs.columns if c.lower() not in new]
    doc, body, lost, turns, rkey, rbody = spare(passed, "_doc", "_body", "_lost", "_turns", "_rkey", "_rbody")
    found = line_bitmaps(docs, key, text, least).toDF(rkey, rbody, lost, turns)
    # Bitmaps are small and make the hash table; texts stream past it unsorted.
    d = docs.select(*map(column, passed), column(key).alias(doc), text_hash(column(text)).alias(body))
    met = d.join(found.hint("shuffle_hash"), F.col(doc).eqNullSafe(F.col(rkey)) & (F.col(body) == F.col(rbody)), "left")
    return met.select(
        *map(column, passed),
        count_lines(column(text)).alias("n_lines"),
        F.coalesce(lost, F.lit(0)).cast("long").alias("n_dropped"),
        F.coalesce(turns, F.array().cast("array<int>")).alias("keep"),
    )


def count_lines(text: Column) -> Column:
    t = F.coalesce(text, F.lit(""))
    return (F.octet_length(t) - F.octet_length(F.replace(t, F.lit("\n"), F.lit(""))) + 1).cast("long")


def kept_text(text: Column, keep: Column) -> Column:
    """The lines of ``text`` that a bitmap keeps, joined by line feeds."""
    t = F.coalesce(text, F.lit(""))
    lengths = F.zip_with(F.concat(F.array(F.lit(0)), keep), F.concat(keep, F.array(count_lines(text).cast("int"))), lambda a, b: b - a)
    stays = F.flatten(F.transform(lengths, lambda n, i: F.array_repeat(i % 2 == 0, n)))
    # Lambdas see their own variables alone: whatever else they named would be computed anew for every line.
    return F.when(F.size(keep) == 0, t).otherwise(F.array_join(F.zip_with(F.split(t, "\n", -1), stays, lambda line, stay: F.when(stay, line)), "\n"))
