"""Dates, weights, codes, pairs and small arithmetic as Column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from concordia.config import CODED_COUNTRIES, EU, EXTERNAL, GROUPS, ISO3, POSITIONS, RELATION_LABELS, TOPICS, TREND_LABELS

DEC = "decimal(18,4)"


def map_of(values: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for kv in values.items() for x in kv])


def lookup(values: dict[str, str], c: Column) -> Column:
    return F.try_element_at(map_of(values), c)


def is_eu(c: Column, eu: list[str] | None = None) -> Column:
    return c.isin(eu or EU)


# dates

def iso_or_mail_timestamp(c: Column) -> Column:
    """ISO-8601, then RFC-2822, then a bare date; without zone UTC; else null. What is parsed always carries its zone, so the session's does not matter."""
    s = F.trim(c)
    day, clock, zone = r"\d{4}-\d{2}-\d{2}", r"[T ]\d{2}:\d{2}(:\d{2}(\.\d+)?)?", r"\s?(Z|[+-]\d{2}:?\d{2})"
    iso = F.when(s.rlike(f"^{day}{clock}{zone}$"), F.try_to_timestamp(s)).when(s.rlike(f"^{day}{clock}$"), F.try_to_timestamp(F.concat(s, F.lit("Z"))))
    iso = iso.when(s.rlike(f"^{day}$"), F.try_to_timestamp(F.concat(s, F.lit("T00:00:00Z"))))
    bare = F.regexp_replace(s, r"^[A-Za-z]{3},\s*", "")
    mail = F.coalesce(F.try_to_timestamp(bare, F.lit("d MMM yyyy HH:mm:ss xx")), F.try_to_timestamp(bare, F.lit("d MMM yyyy HH:mm:ss z")))
    return F.coalesce(iso, F.when(bare.rlike(r"^\d{1,2} [A-Z][a-z]{2} \d{4} "), mail))


def utc_date(ts: Column) -> Column:
    """The UTC day of an instant, whatever the session's zone."""
    return F.date_from_unix_date(F.floor(F.unix_seconds(ts) / 86_400).cast("int"))


def event_timestamp(now: str, *candidates: Column) -> Column:
    """The first candidate that can be read; else ``now``, so undated events are always current."""
    return F.coalesce(*[iso_or_mail_timestamp(c) for c in candidates], F.lit(now).cast("timestamp"))


def storage_date(published: Column, collected: Column) -> Column:
    """UTC date under which an event is stored: RFC-2822 ``published``, else ISO ``collected``, else null."""
    mail = F.when(F.trim(published).rlike(r"^([A-Za-z]{3},\s*)?\d{1,2} [A-Z][a-z]{2} \d{4} "), iso_or_mail_timestamp(published))
    iso = F.when(F.trim(collected).rlike(r"^\d{4}-\d{2}-\d{2}"), iso_or_mail_timestamp(collected))
    return utc_date(F.coalesce(mail, iso))


def export_timestamp(url: Column) -> Column:
    """The 14 digits at the start of an export's file name as a UTC timestamp, else null."""
    digits = F.regexp_extract(F.element_at(F.split(url, "/"), -1), r"^(\d{14})(?!\d)", 1)
    return F.try_to_timestamp(F.concat(F.nullif(digits, F.lit("")), F.lit("+0000")), F.lit("yyyyMMddHHmmssxx"))


# weights and scores

def number_or(text: Column, default: int) -> Column:
    """A number kept in text; missing, empty and unparsable give the default, "0" stays 0."""
    return F.coalesce(F.nullif(F.trim(text), F.lit("")).try_cast(DEC), F.lit(default).cast(DEC))


def event_weight(metadata: Column) -> Column:
    """0.4 mentions + 0.3 articles + 0.3 |cooperation score|, at least 1; exact decimals, so sums do not depend on their order."""
    get = lambda k: F.try_element_at(metadata, F.lit(k))
    part = lambda w, c: (F.lit(w).cast("decimal(2,1)") * c).cast(DEC)
    raw = part("0.4", number_or(get("NumMentions"), 1)) + part("0.3", number_or(get("NumArticles"), 1)) + part("0.3", F.abs(number_or(get("GoldsteinScale"), 0)))
    return F.greatest(raw.cast(DEC), F.lit(1).cast(DEC))


def clamp(c: Column, low: float = 0.0, high: float = 100.0) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), c))


def exact_round(c: Column, digits: int) -> Column:
    """A double rounded half up on its decimal value to 12 places, so equal inputs round equally whatever their last binary digit."""
    return F.round(c.cast("decimal(28,12)"), digits).cast("double")


def band(score: Column) -> Column:
    return F.when(score >= 80, "very_high").when(score >= 60, "high").when(score >= 40, "medium").when(score >= 20, "low").otherwise("very_low")


def vote_relation(weight: Column) -> Column:
    return F.when(weight >= 0.75, "cooperative").when(weight <= 0.35, "conflict").otherwise("neutral")


def relation_label(score: Column) -> Column:
    return F.when(score >= 70, RELATION_LABELS["strong"]).when(score >= 40, RELATION_LABELS["medium"]).otherwise(RELATION_LABELS["weak"])


def trend_label(delta: Column) -> Column:
    return F.when(delta > 5, TREND_LABELS["up"]).when(delta < -5, TREND_LABELS["down"]).otherwise(TREND_LABELS["flat"])


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two equally long arrays of doubles; 0 where either has no length."""
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p * q), F.lit(0.0), lambda s, v: s + v)
    norms = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when(norms > 0, dot(a, b) / norms).otherwise(0.0)


def profile_closeness(a: Column, b: Column) -> Column:
    """1 - half the distance of the normalised absolute profiles; 0 where a profile is missing or both are zero."""
    size = lambda x: F.aggregate(x, F.lit(0.0), lambda s, v: s + F.abs(v))
    share = lambda x: F.transform(x, lambda v: F.when(size(x) > 0, F.abs(v) / size(x)).otherwise(0.0))
    gap = F.aggregate(F.zip_with(share(a), share(b), lambda p, q: F.abs(p - q)), F.lit(0.0), lambda s, v: s + v)
    return F.when(a.isNull() | b.isNull() | ((size(a) == 0) & (size(b) == 0)), 0.0).otherwise(F.greatest(F.lit(0.0), 1 - gap / 2))


# codes

def coded_country(code: Column) -> Column:
    """ISO two-letter code of a coded event's country code, null if unknown."""
    k = F.upper(F.trim(code))
    return F.coalesce(lookup(CODED_COUNTRIES, k), F.when(k.isin(EU + EXTERNAL), k))


def vote_country(code: Column) -> Column:
    """EU code of a two- or three-letter code; '' for all others."""
    k = F.upper(F.trim(F.coalesce(code, F.lit(""))))
    return F.when(k.isin(EU), k).otherwise(F.coalesce(lookup(ISO3, k), F.lit("")))


def vote_group(code: Column) -> Column:
    k = F.upper(F.trim(F.coalesce(code, F.lit(""))))
    return F.coalesce(lookup(GROUPS, k), k)


def vote_position(text: Column) -> Column:
    return F.coalesce(lookup(POSITIONS, F.upper(F.trim(F.coalesce(text, F.lit(""))))), F.lit(""))


def coded_topics(root: Column, code: Column) -> Column:
    """Topics of a coded event by its codes, sorted; ["defence"] where none applies."""
    starts = reduce(lambda a, b: a | b, (code.startswith(p) for p in ("112", "113", "120", "121", "122", "123")))
    found = F.array(
        F.when(root.isin("19", "20"), F.lit("defence")), F.when(root.isin("19", "20"), F.lit("ukraine_russia")),
        F.when(root.isin("13", "14", "17"), F.lit("rule_of_law")), F.when(root.isin("05", "06", "07", "08") | starts, F.lit("trade")), F.when(starts, F.lit("fiscal")),
    )
    topics = F.array_sort(F.array_distinct(F.array_compact(found)))
    return F.when(F.size(topics) > 0, topics).otherwise(F.array(F.lit("defence")))


# arrays

def text_array(c: Column) -> Column:
    return F.coalesce(c, F.array().cast("array<string>"))


def sorted_set(c: Column) -> Column:
    return F.array_sort(F.array_distinct(F.array_compact(text_array(c))))


def country_pairs(countries: Column) -> Column:
    """All (a, b) with a before b of a sorted list."""
    return F.flatten(F.transform(countries, lambda x, i: F.transform(F.slice(countries, i + 2, F.greatest(F.size(countries), F.lit(1))), lambda y: F.array(x, y))))


def split_groups(countries: Column, eu: list[str] | None = None) -> Column:
    return F.struct(F.filter(countries, lambda c: is_eu(c, eu)).alias("eu"), F.filter(countries, lambda c: ~is_eu(c, eu)).alias("external"))


def pair_type(a: Column, b: Column, eu: list[str] | None = None) -> Column:
    both, one = is_eu(a, eu) & is_eu(b, eu), is_eu(a, eu) != is_eu(b, eu)
    return F.when(both, "internal").when(one, "external").otherwise("other")


def pair_modes(kind: Column) -> Column:
    """The modes a pair of this type belongs to: its own and all; none for external-external pairs."""
    return F.when(kind == "other", F.array().cast("array<string>")).otherwise(F.array(F.lit("all"), kind))


def topic_vector(values: Column, topics: list[str] | None = None) -> Column:
    """A map topic -> value as an array in topic order, 0 where absent."""
    return F.array(*[F.coalesce(F.try_element_at(values, F.lit(t)), F.lit(0.0)) for t in topics or TOPICS])


def partner_of(country: str, source: Column, target: Column) -> Column:
    return F.when(source == country, target).otherwise(source)
