"""Text cleaning and matching as Column expressions (the two that need Unicode tables Spark lacks are Arrow UDFs)."""

from __future__ import annotations

import html
import re
import unicodedata
from functools import reduce

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from concordia.config import POSITION_WORDS

_URL = r"(?i)(?:https?://\S+|www\.\S+)"
_EMAIL = r"(?U)\b[\w.-]+@[\w.-]+\.\w+\b"


@F.pandas_udf(T.StringType())
def unescape(s: pd.Series) -> pd.Series:
    """HTML character references resolved once."""
    return s.map(lambda x: html.unescape(x) if x is not None and "&" in x else x)


@F.pandas_udf(T.StringType())
def strip_accents(s: pd.Series) -> pd.Series:
    """Compatibility-decomposed, combining marks left out."""
    return s.map(lambda x: x if x is None else "".join(c for c in unicodedata.normalize("NFKD", x) if not unicodedata.combining(c)))


def person_key(name: str) -> str:
    """Name as a match key: lower case, no marks, hyphens and other non-word characters as blanks."""
    bare = "".join(c for c in unicodedata.normalize("NFD", name.lower()) if unicodedata.category(c) != "Mn")
    return " ".join(re.sub(r"[^\w\s]", " ", bare.replace("-", " ")).split())


@F.pandas_udf(T.StringType())
def person_name(s: pd.Series) -> pd.Series:
    """:func:`person_key` of a column."""
    return s.map(lambda x: None if x is None else person_key(x))


def collapse_whitespace(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(c, r"(?U)\s+", " "), "^ | $", "")


def normalize_quotes(c: Column) -> Column:
    """Curly quotes straight, dashes to hyphens, no-break blanks to blanks."""
    return F.translate(c, "‘’“”–— ", "''\"\"-- ")


def remove_urls(c: Column) -> Column:
    return F.regexp_replace(c, _URL, " ")


def remove_emails(c: Column) -> Column:
    return F.regexp_replace(c, _EMAIL, " ")


def basic_clean(c: Column, resolve_references: bool = True) -> Column:
    """Null as '', character references resolved, quotes and dashes plain, white space collapsed."""
    c = F.coalesce(c, F.lit(""))
    return collapse_whitespace(normalize_quotes(unescape(c) if resolve_references else c))


def normalize_text(c: Column, lowercase: bool = True, links: bool = True, emails: bool = True, diacritics: bool = False, resolve_references: bool = True) -> Column:
    """Cleaned text; ``links`` and ``emails`` remove these, ``diacritics`` removes accents."""
    c = basic_clean(c, resolve_references)
    if links:
        c = remove_urls(c)
    if emails:
        c = remove_emails(c)
    c = collapse_whitespace(c)
    if diacritics:
        c = strip_accents(c)
    return F.lower(c) if lowercase else c


def searchable_text(*parts: Column, resolve_references: bool = True) -> Column:
    """The non-empty parts joined and normalised in lower case, accents kept."""
    return normalize_text(F.concat_ws(" ", *[F.nullif(p, F.lit("")) for p in parts]), resolve_references=resolve_references)


def normalize_title(c: Column) -> Column:
    return F.lower(F.regexp_replace(F.coalesce(c, F.lit("")), r"(?U)^\s+|\s+$", ""))


def hash_title(c: Column) -> Column:
    return F.sha2(normalize_title(c), 256)


def topic_text(c: Column) -> Column:
    """Vote titles as matched against keywords."""
    c = F.translate(F.lower(F.coalesce(c, F.lit(""))), "’–—_/", "'    ")
    return collapse_whitespace(c)


def contains_any(c: Column, words: list[str]) -> Column:
    return reduce(lambda a, b: a | b, (F.contains(c, F.lit(w)) for w in words))


def vote_label(c: Column, words: dict[str, list[str]] | None = None) -> Column:
    """The position that a text's words tell, the first that applies; null without any."""
    low = F.lower(c)
    return reduce(lambda done, w: F.when(contains_any(low, w[1]), w[0]).otherwise(done), reversed((words or POSITION_WORDS).items()), F.lit(None).cast("string"))


def strip_namespace(tag: Column) -> Column:
    return F.substring_index(tag, "}", -1)


def vote_title(display: Column, reference: Column, description: Column, procedure: Column, vote_id: Column) -> Column:
    """Non-empty parts joined by a dash; else the procedure's title; else the number. Null parts are empty."""
    clean = lambda c: F.nullif(F.trim(F.coalesce(c, F.lit(""))), F.lit(""))
    joined = F.nullif(F.concat_ws(" — ", clean(display), clean(reference), clean(description)), F.lit(""))
    return F.coalesce(joined, clean(procedure), F.concat(F.lit("EP vote "), vote_id.cast("string")))


def signed(c: Column, digits: int = 2) -> Column:
    return F.when(c > 0, F.format_string(f"+%.{digits}f", c.cast("double"))).otherwise(F.format_string(f"%.{digits}f", c.cast("double")))


def label_map(labels: dict[str, str], c: Column) -> Column:
    """A label for each known key, others as they are."""
    return F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in labels.items() for x in kv]), c), c)
