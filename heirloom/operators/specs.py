"""People as typed rows from loosely named JSON objects."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from heirloom.functions import text as T

# Names that one field goes by.
SYNONYMS = {
    "birth_date": ["birth_date", "birthDate"],
    "death_date": ["death_date", "deathDate"],
    "birth_year": ["birth_year", "birthYear", "birth"],
    "death_year": ["death_year", "deathYear", "death"],
    "birth_place": ["birth_place", "birthPlace"],
    "death_place": ["death_place", "deathPlace"],
    "gender": ["gender", "sex"],
    "occupation": ["occupation", "profession", "job"],
    "biography": ["biography", "bio", "about"],
    "aliases": ["aliases", "aka", "also_known_as"],
}
FALSY = ["null", '""', "{}", "[]", "0", "0.0", "false"]


def _held(v: Column, name: str) -> Column:
    f = F.try_variant_get(v, f"$.{name}", "variant")
    return F.when(~F.to_json(f).isin(FALSY), f)


def person_spec(v: Column) -> Column:
    """A person of a variant object: name, dates, years, places, gender, occupation, biography and aliases.

    The first synonym that holds something counts.  Aliases are a list or a text
    with commas.  Null without a name.
    """
    first = {k: F.coalesce(*[_held(v, n) for n in names]) for k, names in SYNONYMS.items()}
    word = lambda c: F.try_variant_get(c, "$", "string")
    name = F.nullif(F.trim(F.try_variant_get(v, "$.name", "string")), F.lit(""))
    many = F.coalesce(F.try_variant_get(first["aliases"], "$", "array<string>"), F.split(word(first["aliases"]), ","), F.array().cast("array<string>"))
    aliases = F.filter(F.transform(many, lambda x: F.trim(x)), lambda x: x != "")
    plain = [word(first[k]).alias(k) for k in ("birth_date", "death_date", "birth_place", "death_place", "gender", "biography")]
    years = [T.coerce_year(word(first[k])).alias(k) for k in ("birth_year", "death_year")]
    spec = F.struct(name.alias("name"), *plain, *years, F.nullif(F.trim(word(first["occupation"])), F.lit("")).alias("occupation"), aliases.alias("aliases"))
    return F.when(name.isNotNull(), spec)


def payload_names(payload: Column) -> Column:
    """Every ``name`` of a JSON text, at any depth, in order of place."""
    found = F.regexp_extract_all(payload, F.lit(r'"name"\s*:\s*"((?:[^"\\]|\\.)*)"'), F.lit(1))
    return F.filter(F.transform(found, lambda x: F.trim(F.try_variant_get(F.try_parse_json(F.concat(F.lit('"'), x, F.lit('"'))), "$", "string"))), lambda x: x != "")
