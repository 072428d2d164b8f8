"""What external parsers leave behind, and runs over many files."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from heirloom.cut import cut
from heirloom.sources import supervised

IMAGE_FIELDS = ("img_path", "table_img_path", "equation_img_path")


def absolute_images(items: DataFrame, base: str = "base_dir") -> DataFrame:
    """Image paths of content items, relative to ``base``, made absolute; blank ones stay."""
    def full(c: str) -> Column:
        p = F.col(c)
        return F.when((F.trim(p) != "") & ~p.startswith("/"), F.concat_ws("/", F.regexp_replace(base, "/+$", ""), F.regexp_replace(p, r"^(?:\./)+", ""))).otherwise(p)

    return items.withColumns({c: full(c) for c in IMAGE_FIELDS if c in items.columns})


def flatten_docling(docs: DataFrame, doc: str = "doc", value: str = "value", max_depth: int = 100) -> DataFrame:
    """The content items of documents that are trees of blocks with ``$ref`` children.

    Returns ``doc, path, type, num, text, text_format, caption, footnote, body, image, page_idx``,
    in the order of ``path``.  A node counts one more than what it was given; its
    children count on from there by their places, without what lies below their
    elder siblings; ten counts make a page.  ``image`` holds the decoded picture.
    One join for each level of the trees.
    """
    v = F.try_parse_json(F.col(value))
    tree = docs.select(F.col(doc).alias("doc"), v.alias("v"))
    get = lambda c, path, kind: F.try_variant_get(c, path, kind)
    some = [tree.select("doc", F.lit(k).alias("type"), F.posexplode(get("v", f"$.{k}", "array<variant>")).alias("num", "node")) for k in ("texts", "pictures", "tables", "groups")]
    nodes = some[0].unionByName(some[1]).unionByName(some[2]).unionByName(some[3])
    refs = F.transform(get("node", "$.children", "array<variant>"), lambda c: get(c, "$[\'$ref\']", "string"))
    nodes = cut(nodes.withColumn("refs", F.coalesce(refs, F.array().cast("array<string>"))))
    roots = F.transform(get("v", "$.body.children", "array<variant>"), lambda c: get(c, "$[\'$ref\']", "string"))
    level = tree.select("doc", F.posexplode(roots).alias("i", "ref")).select("doc", "ref", F.array("i").alias("path"), (F.col("i") + 1).alias("given"))
    found = None
    for _ in range(max_depth):
        step = level.withColumns({"type": F.split_part("ref", F.lit("/"), F.lit(2)), "num": F.split_part("ref", F.lit("/"), F.lit(3)).cast("int")})
        here = cut(step.join(nodes, ["doc", "type", "num"]))
        group = F.col("type").isin("groups", "body")
        leaf = F.size("refs") == 0
        counted = here.withColumn("count", F.col("given") + F.when(leaf | ~group, 1).otherwise(0))
        items = counted.where(leaf | ~group).select("doc", "path", "type", "num", "node", "count")
        found = items if found is None else found.unionByName(items)
        level = counted.select("doc", "path", "count", F.posexplode("refs").alias("i", "ref")).select("doc", "ref", F.array_append("path", F.col("i")).alias("path"), (F.col("count") + F.col("i") + 1).alias("given"))
        level = cut(level)
        if not level.limit(1).count():
            break
    else:
        raise RuntimeError(f"blocks lie deeper than {max_depth} levels")
    text = lambda f: get("node", f"$.{f}", "string")
    uri = F.try_element_at(F.split(get("node", "$.image.uri", "string"), ","), F.lit(2))
    picture, lost = F.col("kind") == "pictures", F.col("uri").isNull()
    d = found.withColumnRenamed("type", "kind").withColumn("uri", uri)
    kind = F.when(F.col("kind") == "texts", F.when(text("label") == "formula", "equation").otherwise("text")).when(picture, F.when(lost, "text").otherwise("image")).otherwise("table")
    body = F.when(F.col("kind") == "texts", text("orig")).when(picture & lost, F.concat(F.lit("[Image processing failed: "), F.coalesce(text("caption"), F.lit("")), F.lit("]")))
    d = d.withColumns({
        "type": kind, "text": body, "text_format": F.when(F.col("kind").eqNullSafe("texts") & (text("label") == "formula"), "unknown"),
        "caption": F.when(kind.isin("image", "table"), F.coalesce(text("caption"), F.lit(""))), "footnote": F.when(kind.isin("image", "table"), F.coalesce(text("footnote"), F.lit(""))),
        "body": F.when(kind == "table", F.coalesce(F.to_json(get("node", "$.data", "variant")), F.lit("[]"))), "image": F.when(kind == "image", F.try_to_binary("uri", F.lit("base64"))), "page_idx": F.floor(F.col("count") / 10).cast("int"),
    })
    return d.select("doc", "path", "type", "num", "text", "text_format", "caption", "footnote", "body", "image", "page_idx")


BATCH = "path string, out_dir string, success boolean, error string, seconds double"


def run_batch(files: DataFrame, parse: Callable[[str, str], None], dry_run: bool = False, seconds: float | None = None, at_once: int = 4) -> DataFrame:
    """Call ``parse(path, out_dir)`` for every file, each on its own: an exception becomes the row's error.

    ``files`` has ``path, out_dir``.  With ``seconds``, each file has a child process of its own, ``at_once`` of them in a task;
    one that takes longer is ended with all that it started, and its row says that it timed out.  A parser that
    brings its process down costs its own file only.  A dry run calls nothing and reports success.
    """

    def one(path: str, out_dir: str) -> supervised.Outcome:
        began = time.perf_counter()
        try:
            parse(path, out_dir)
        except Exception as e:  # noqa: BLE001  the row carries the failure
            return False, str(e) or type(e).__name__, time.perf_counter() - began
        return True, None, time.perf_counter() - began

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            tasks = list(zip(f["path"], f["out_dir"], strict=True))
            if dry_run:
                done = [(True, None, 0.0)] * len(tasks)
            elif seconds:
                done = list(supervised.each(parse, tasks, seconds, at_once))
            else:
                done = [one(*t) for t in tasks]
            yield pd.DataFrame({"path": f["path"], "out_dir": f["out_dir"], "success": [d[0] for d in done], "error": [d[1] for d in done], "seconds": [d[2] for d in done]})

    return files.select("path", "out_dir").mapInPandas(run, BATCH)


def batch_summary(results: DataFrame) -> DataFrame:
    """``files, succeeded, failed, success_rate`` (in percent, 0 without files) of a batch."""
    n, ok = F.count(F.lit(1)), F.count(F.when(F.col("success"), 1))
    return results.agg(n.alias("files"), ok.alias("succeeded"), (n - ok).alias("failed"), F.when(n > 0, 100.0 * ok / n).otherwise(0.0).alias("success_rate"))


# Inline marks and the tags that they become, in the order in which they are replaced.
INLINE = [
    ("&", "&amp;"),
    ("<", "&lt;"),
    (">", "&gt;"),
    (r"\*\*(.*?)\*\*", "<b>$1</b>"),
    (r"__(.*?)__", "<b>$1</b>"),
    (r"(?<!\w)\*([^*\n]+?)\*(?!\w)", "<i>$1</i>"),
    (r"(?<!\w)_([^_\n]+?)_(?!\w)", "<i>$1</i>"),
    (r"`([^`]+?)`", '<font name="Courier" size="9" color="darkred">$1</font>'),
    (r"\[([^\]]+?)\]\(([^)]+?)\)", '<link href="$2" color="blue"><u>$1</u></link>'),
    (r"~~(.*?)~~", "<strike>$1</strike>"),
]


def inline_markdown(text: Column) -> Column:
    """The inline marks of a line as the tags of a page."""
    for mark, tag in INLINE:
        text = F.regexp_replace(text, mark, tag)
    return text
