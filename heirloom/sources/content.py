"""Content lists, artifacts and living graphs as DataFrames."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from heirloom.functions import text as T
from heirloom.sources import json_arrays


def content_items(spark: SparkSession, path: str) -> DataFrame:
    """``source_path, ordinal, type, text, page_idx`` of every object in JSON-array files.

    ``path`` is a ``.json`` file or a folder: its ``*_content_list.json`` files at
    any depth, else its ``*.json`` files.  Items that are no objects are dropped.
    A long file is read by many tasks, see ``json_arrays``.  A file that holds no
    JSON array, or whose array breaks off, fails the query; a missing last bracket
    alone is forgiven; an empty file has no items.
    """
    glob = None
    if not path.endswith(".json"):
        names = spark.read.format("binaryFile").option("recursiveFileLookup", True)
        glob = "*_content_list.json" if names.option("pathGlobFilter", "*_content_list.json").load(path).select("path").limit(1).count() else "*.json"
    return items_of(json_arrays.array_items(spark, path, glob))


def items_of(found: DataFrame) -> DataFrame:
    """``source_path, ordinal, type, text, page_idx`` of array items as JSON text; an item that is no JSON fails the query."""
    v = F.parse_json("item")
    get = lambda field, kind: F.try_variant_get("v", f"$.{field}", kind).alias(field)
    return found.select(F.col("file").alias("source_path"), "pos", v.alias("v")).select("source_path", get("type", "string"), get("text", "string"), get("page_idx", "int"), F.col("pos").cast("int").alias("ordinal"))


def chunks(items: DataFrame) -> DataFrame:
    """Text items that are not blank, with ids of source and chunk."""
    body = F.trim(F.col("text"))
    source = T.stable_id("source", F.col("source_path"))
    kept = items.where((F.col("type") == "text") & (body != "")).withColumns({"text": body, "source_id": source})
    cid = T.stable_id("chunk", F.col("source_id"), (F.col("page_idx"), "int"), (F.col("ordinal"), "int"), F.col("text"))
    return kept.withColumn("chunk_id", cid)


def jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines of a fixed schema; blank lines are skipped, a broken line fails the query."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def living_graph(spark: SparkSession, path: str, entities: str, relations: str) -> tuple[DataFrame, DataFrame]:
    """The two tables of a living-graph JSON file; relations with ``relation_no``, their place."""
    one = spark.read.schema(f"entities array<struct<{entities}>>, relations array<struct<{relations}>>").option("multiLine", True).json(path)
    return one.select(F.inline("entities")), one.select(F.posexplode("relations").alias("relation_no", "r")).select("relation_no", "r.*")


def reference_people(spark: SparkSession, path: str) -> DataFrame:
    """``ref, name, normalized_name, birth_year, death_year, birth_place, death_place, aliases`` of a JSON array of people, in its order."""
    raw = spark.read.option("wholetext", True).text(path)
    parsed = F.try_parse_json("value")
    whole = F.when(F.coalesce(F.schema_of_variant(parsed).startswith("ARRAY"), F.lit(False)), F.try_variant_get(parsed, "$", "array<variant>")).otherwise(F.raise_error(F.lit(f"no JSON array: {path}")))
    get = lambda field, kind: F.try_variant_get("v", f"$.{field}", kind).alias(field)
    rows = raw.select(F.posexplode(whole).alias("ref", "v")).select(
        F.col("ref").cast("long").alias("ref"), get("name", "string"), get("normalized_name", "string"), get("birth_year", "int"), get("death_year", "int"), get("birth_place", "string"), get("death_place", "string"), get("aliases", "array<string>")
    )
    return rows.where(F.trim("name") != "")


def artifact_folder(path: str, name: str = "people") -> str:
    """The folder of an artifact set, given itself or one of its tables."""
    bare = path.rstrip("/")
    return os.path.dirname(bare) if os.path.basename(bare).split(".")[0] == name else bare


def files(spark: SparkSession, path: str, extensions: list[str]) -> DataFrame:
    """Files to parse, by extension, with the output folder that a batch run gives each."""
    f = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    ext = F.lower(F.regexp_extract("path", r"(\.[^./]+)$", 1))
    return f.withColumns({"ext": ext, "out_dir": output_folder(F.col("path"))}).where(F.col("ext").isin(extensions))


def output_folder(path: Column) -> Column:
    stem = F.regexp_replace(F.regexp_extract(path, r"([^/]+)$", 1), r"\.[^.]*$", "")
    return F.concat(stem, F.lit("-"), F.substring(F.md5(path), 1, 8))


def parser_kind(ext: Column) -> Column:
    """Which parser reads a file."""
    return (
        F.when(ext == ".pdf", "pdf").when(ext.isin(".png", ".jpg", ".jpeg", ".bmp", ".tiff", ".gif", ".webp"), "image").when(ext.isin(".doc", ".docx", ".ppt", ".pptx", ".xls", ".xlsx"), "office")
        .when(ext.isin(".html", ".htm", ".xhtml"), "html").when(ext.isin(".txt", ".md"), "text").otherwise("pdf")
    )


def offline() -> bool:
    """Whether the environment forbids network access."""
    return os.environ.get("HEIRLOOM_OFFLINE", "").strip().lower() in {"1", "true", "yes", "on"}
