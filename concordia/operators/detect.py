"""Countries and topics of texts by dictionary, as one regular expression per entry and no UDF."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from concordia.config import COUNTRY_ALIASES, TOPIC_KEYWORDS, TOPICS, VOTE_TOPIC_KEYWORDS
from concordia.functions.text import contains_any, searchable_text, topic_text


def alias_pattern(aliases: list[str]) -> str:
    """Any of the aliases as whole words, blanks matching any white space."""
    words = sorted({a.lower() for a in aliases}, key=lambda a: (-len(a), a))
    return r"(?iU)\b(?:" + "|".join(r"\s+".join(re.escape(p) for p in w.split()) for w in words) + r")\b"


def detect_countries(text: Column, aliases: dict[str, list[str]] | None = None) -> Column:
    """Sorted codes of the countries named in an already normalised text."""
    entries = sorted((aliases or COUNTRY_ALIASES).items())
    return F.array_compact(F.array(*[F.when(text.rlike(alias_pattern(words)), F.lit(code)) for code, words in entries]))


def detect_topics(text: Column, keywords: dict[str, list[str]] | None = None) -> Column:
    """Topics any of whose keywords is contained in the text (also within words), in topic order."""
    keywords = keywords or TOPIC_KEYWORDS
    return F.array_compact(F.array(*[F.when(contains_any(text, words), F.lit(t)) for t, words in keywords.items()]))


def score_topics(text: Column, keywords: dict[str, list[str]] | None = None) -> Column:
    """Topic -> number of its distinct keywords in the text, topics without any left out."""
    keywords = keywords or TOPIC_KEYWORDS
    entries = []
    for t, words in keywords.items():
        n = sum((F.contains(text, F.lit(w)).cast("int") for w in dict.fromkeys(words)), F.lit(0))
        entries.append(F.struct(F.lit(t).alias("key"), n.alias("value")))
    return F.map_filter(F.map_from_entries(F.array(*entries)), lambda k, v: v > 0)


def primary_topic(scores: Column, topics: list[str] | None = None) -> Column:
    """The topic with the highest score, the first in topic order among equals; null without any."""
    ranked = F.array(*[F.struct(F.coalesce(F.try_element_at(scores, F.lit(t)), F.lit(0)).alias("n"), F.lit(-i).alias("at"), F.lit(t).alias("topic")) for i, t in enumerate(topics or TOPICS)])
    best = F.array_max(ranked)
    return F.when(best["n"] > 0, best["topic"])


def from_parts(*parts: Column, resolve_references: bool = True) -> Column:
    """The text the detectors see: the parts normalised twice over, so twice escaped references resolve."""
    return searchable_text(searchable_text(*parts, resolve_references=resolve_references), resolve_references=resolve_references)


def vote_topic(title: Column, keywords: dict[str, list[str]] | None = None, default: str = "trade") -> Column:
    """The first topic in order of priority with a keyword in the title."""
    text, out = topic_text(title), F.lit(default)
    for topic, words in reversed((keywords or VOTE_TOPIC_KEYWORDS).items()):
        out = F.when(contains_any(text, words), F.lit(topic)).otherwise(out)
    return out
