"""Parts of names, their likeness, and their places in quotes, as Column expressions."""

from __future__ import annotations

from collections.abc import Sequence
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from heirloom.functions import text as T
from heirloom.functions import vocab as V

ROMAN = "^[ivxlcdm]+$"
_LETTER = r"[\p{L}\p{N}_]"


def name_tokens(x: Column) -> Column:
    """Lower-case words of letters, digits and underscores; none for null."""
    return F.filter(F.split(F.regexp_replace(F.lower(F.coalesce(x, F.lit(""))), r"[^\p{L}\p{N}_\s]", " "), r"(?U)\s+"), lambda t: t != "")


def person_tokens(x: Column) -> Column:
    """``name_tokens`` without titles, or with them where nothing else is left."""
    every = name_tokens(x)
    bare = F.filter(every, lambda t: ~t.isin(V.TITLES))
    return F.when(F.size(bare) > 0, bare).otherwise(every)


def core_tokens(tokens: Column) -> Column:
    return F.filter(tokens, lambda t: ~t.rlike(ROMAN))


def first_name(x: Column) -> Column:
    """The first token that is no title and no numeral; null if there is none."""
    return F.get(core_tokens(person_tokens(x)), F.lit(0))


def patronymic(x: Column) -> Column:
    ends = f"(?:{'|'.join(V.PATRONYMICS)})$"
    return F.get(F.filter(name_tokens(x), lambda t: t.rlike(ends) & ~t.isin(V.NOT_PATRONYMICS)), F.lit(0))


def token_root(x: Column) -> Column:
    return F.regexp_replace(x, f"[{V.FINAL_VOWELS}]+$", "")


def patronymic_root(x: Column) -> Column:
    """The stem of a patronymic: the first ending that fits and leaves two letters is cut, then vowels."""
    cut = F.coalesce(*[F.when(x.endswith(e) & (F.length(x) > len(e) + 1), F.regexp_replace(x, f"{e}$", "")) for e in V.PATRONYMIC_ENDINGS], x)
    return token_root(cut)


def patronymic_parent(parent: Column, child: Column) -> Column:
    """Whether the child's patronymic comes from the parent's first name; false where either is missing."""
    p, c = token_root(first_name(parent)), patronymic_root(patronymic(child))
    probe = F.substring(p, F.lit(1), F.greatest(F.lit(3), F.least(F.lit(6), F.length(p))))
    return F.coalesce((p != "") & (c != "") & ((p == c) | c.startswith(probe)), F.lit(False))


def has_cue(cue: Column, words: Sequence[str]) -> Column:
    """Whether a cue text (``text.cue_text``) has one of the words or phrases."""
    return cue.rlike("(?: " + " | ".join(words) + " )")


def cue_place(cue: Column, words: Sequence[str]) -> Column:
    """Characters before the first of the words' occurrences, each with the space before it; null if none."""
    return F.least(*[F.nullif(F.instr(cue, f" {w} "), F.lit(0)) for w in words]) - 1


def name_place(name: Column, cue: Column) -> Column:
    """Characters before the first whole-word occurrence of a name: all of it, its first two tokens, or a first token of four letters or more."""
    t = name_tokens(name)
    forms = [F.array_join(t, " "), F.when(F.size(t) >= 2, F.array_join(F.slice(t, 1, 2), " ")), F.when(F.length(F.get(t, F.lit(0))) >= 4, F.get(t, F.lit(0)))]
    at = [F.when(f != "", F.nullif(F.regexp_instr(cue, F.concat(F.lit(f"(?<!{_LETTER})"), f, F.lit(f"(?!{_LETTER})"))), F.lit(0))) for f in forms]
    return F.least(*at) - 1


def relation_quote(evidence: Column | None, quote: Column | None = None) -> Column:
    """The quotes of an array of evidence and a quote of the relation's own, joined by spaces."""
    some = [F.transform(F.coalesce(evidence, F.array()), lambda e: F.trim(e["quote"]))] if evidence is not None else []
    own = [F.array(F.trim(quote))] if quote is not None else []
    return F.array_join(F.filter(F.concat(*some, *own), lambda x: x != ""), " ")


def parent_segment(cue: Column) -> Column:
    """Tokens from the first child cue to the next punctuation mark; null without a cue."""
    at = cue_place(cue, V.SEGMENT_CUES)
    part = F.regexp_extract(F.substring(cue, at + 1, F.length(cue)), "^[^,.;!?]*", 0)
    return F.when(at.isNotNull(), T.tokens(part))


@F.pandas_udf(DoubleType())
def token_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Ratcliff-Obershelp likeness, which Spark lacks; null where either text is null, 0 where one is empty."""
    return pd.Series([None if x is None or y is None else SequenceMatcher(None, x, y).ratio() if x and y else 0.0 for x, y in zip(a, b, strict=True)], dtype="float64")


@F.pandas_udf(DoubleType())
def best_ratio(tokens: pd.Series, token: pd.Series) -> pd.Series:
    """The highest likeness of a token to one of an array's tokens."""
    return pd.Series([None if t is None or y is None else max((SequenceMatcher(None, x, y).ratio() for x in t if x and y), default=0.0) for t, y in zip(tokens, token, strict=True)], dtype="float64")


def mentions_name(segment: Column, name: Column) -> Column:
    """Whether a segment's tokens have a word like a name's first token (likeness 0.78 of the stems)."""
    return F.coalesce(best_ratio(F.transform(segment, token_root), token_root(first_name(name))) >= 0.78, F.lit(False))


def parent_anchor(cue: Column, source: Column, target: Column, needed: Column) -> Column:
    """How a quote speaks for the source as parent, 2 to -2; 0 without an explicit cue or where not ``needed``."""
    told = needed & (cue != "") & has_cue(cue, V.PARENT_CUES)
    # Rows that do not need it send null, so that the Python step has nothing to compare.
    segment = F.when(told, F.coalesce(parent_segment(cue), F.array().cast("array<string>")))
    s, t = mentions_name(segment, source), mentions_name(segment, target)
    return F.when(~told | told.isNull(), 0).when(F.size(segment) == 0, -1).when(s & ~t, 2).when(t & ~s, -2).when(s, 1).otherwise(-1)
