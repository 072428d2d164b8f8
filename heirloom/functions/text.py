"""Scalar text functions as native Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from heirloom.functions import vocab as V


def compact(x: Column) -> Column:
    """Runs of whitespace become one space; the ends are trimmed."""
    return F.trim(F.regexp_replace(x, r"(?U)\s+", " "))


def normalize_name(x: Column) -> Column:
    """Letters, digits and spaces only, lower case, single spaces; null becomes empty."""
    return F.trim(F.regexp_replace(F.lower(F.coalesce(x, F.lit(""))), r"[^\p{L}\p{N}]+", " "))


def normalize_place(x: Column) -> Column:
    return F.nullif(F.trim(x), F.lit(""))


def match_tokens(x: Column) -> Column:
    """Latin and Cyrillic tokens in lower case, ё as е; null stays null."""
    return F.regexp_extract_all(F.replace(F.lower(x), F.lit("ё"), F.lit("е")), F.lit("[0-9a-zа-я]+"), F.lit(0))


def match_normalize(x: Column) -> Column:
    """The ``match_tokens`` joined by spaces; null becomes empty."""
    return F.array_join(match_tokens(F.coalesce(x, F.lit(""))), " ")


def tokens(x: Column) -> Column:
    return F.regexp_extract_all(F.lower(F.coalesce(x, F.lit(""))), F.lit("[0-9a-zа-яё]+"), F.lit(0))


def coerce_year(x: Column) -> Column:
    """The first digits of a text, four at most."""
    return F.substring(F.regexp_extract(x, r"(\d+)", 1), 1, 4).try_cast("int")


def strict_year(x: Column) -> Column:
    """A whole number from 1 to 2500, else null."""
    y = x.try_cast("int")
    return F.when(y.between(1, 2500), y)


def year_range(x: Column) -> tuple[Column, Column]:
    """Birth and death of the first range of years, in ascending order."""
    a = F.regexp_extract(x, V.YEARS_ANYWHERE, 1).try_cast("int")
    b = F.regexp_extract(x, V.YEARS_ANYWHERE, 2).try_cast("int")
    return F.least(a, b), F.greatest(a, b)


def clean_name(x: Column) -> Column:
    """Without notes of years, outer punctuation and trailing noise words (one word always stays)."""
    bare = F.regexp_replace(x, f"(?iu){V.YEARS_NOTE}", " ")
    bare = compact(F.regexp_replace(bare, f"^[{V.STRIP}]+|[{V.STRIP}]+$", ""))
    noise = "|".join(V.NOISE_SUFFIXES)
    return F.regexp_replace(bare, rf"(?iu)^(.*?\S)(?:\s+[.,;:!?]*(?:{noise})[.,;:!?]*)+$", "$1")


def roman_numeral(x: Column) -> Column:
    found = F.regexp_extract_all(F.lower(x), F.lit(r"\b[ivxlcdm]+\b"), F.lit(0))
    return F.when(F.size(found) > 0, F.element_at(found, -1))


def cue_text(x: Column) -> Column:
    """For cue search: lower case, single spaces, a space at either end; empty stays empty."""
    t = compact(F.replace(F.lower(F.coalesce(x, F.lit(""))), F.lit(" "), F.lit(" ")))
    return F.when(t == "", F.lit("")).otherwise(F.concat(F.lit(" "), t, F.lit(" ")))


def gender(x: Column) -> Column:
    g = F.lower(F.trim(x))
    return F.when(g.isin(V.MALE), F.lit("male")).when(g.isin(V.FEMALE), F.lit("female"))


def confidence(x: Column, default: float = 0.65) -> Column:
    return F.least(F.greatest(F.coalesce(x.try_cast("double"), F.lit(default)), F.lit(0.0)), F.lit(1.0))


def relation_type(x: Column) -> Column:
    return F.coalesce(F.nullif(F.trim(x), F.lit("")), F.lit("related_to"))


def slug(x: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(x), "[^a-z0-9]+", "-"), "^-+|-+$", "")


def intent(x: Column) -> Column:
    """What a question asks for: parents before children before spouses before relationships, else the person."""
    return intent_of(F.split(normalize_name(x), " "))


def intent_of(t: Column) -> Column:
    """``intent`` of the words of a normalized text."""
    asks = lambda words: F.arrays_overlap(t, F.array(*[F.lit(w) for w in words]))
    return (
        F.when(asks(V.PARENT_INTENT), "parents").when(asks(V.CHILD_INTENT), "children").when(asks(V.SPOUSE_INTENT), "spouses").when(asks(V.RELATION_INTENT), "relationships").otherwise("person")
    )


def contains_phrase(text: Column, phrase: Column) -> Column:
    """A whole-token phrase inside a text, both normalized."""
    pad = lambda c: F.concat(F.lit(" "), c, F.lit(" "))
    return (phrase != "") & pad(text).contains(pad(phrase))


def stable_id(prefix: str, *parts: Column | tuple[Column, str]) -> Column:
    """``prefix-md5`` over the parts joined by newlines; null and, given as (column, "int"), zero count as empty."""
    texts = []
    for p in parts:
        column, kind = p if isinstance(p, tuple) else (p, "string")
        texts.append(F.coalesce((F.nullif(column, F.lit(0)) if kind == "int" else column).cast("string"), F.lit("")))
    return F.concat(F.lit(f"{prefix}-"), F.md5(F.concat_ws("\n", *texts)))


def gendered(male: str, female: str, other: str, g: Column) -> Column:
    return F.when(g == "male", male).when(g == "female", female).otherwise(other)
