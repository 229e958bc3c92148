"""Building, filtering and deduplicating event records."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from concordia.config import EU
from concordia.functions import scalars as S
from concordia.functions.text import hash_title
from concordia.operators.detect import detect_countries, detect_topics, from_parts, primary_topic, score_topics
from concordia.runtime import settled

LAYERS = ["official", "rss", "gdelt"]


def layer_name(c: Column) -> Column:
    """Trimmed, lower case; an error for any layer not known."""
    name = F.lower(F.trim(c))
    return F.when(name.isin(LAYERS), name).otherwise(F.raise_error(F.concat(F.lit("unknown layer: "), F.coalesce(c, F.lit("null")))))


def build_text_events(items: DataFrame, layer: str = "rss", aliases: dict[str, list[str]] | None = None, keywords: dict[str, list[str]] | None = None) -> DataFrame:
    """Feed items (source_name, source_type, title, summary, body, url, published_at, collected_at) to event records with topics, countries, groups and pairs.

    ``aliases`` (country code -> names) and ``keywords`` (topic -> words) take the place of the usual dictionaries.
    """
    strip = lambda c: F.trim(F.coalesce(F.col(c), F.lit("")))
    base = items.select(
        layer_name(F.lit(layer)).alias("layer"), strip("source_name").alias("source_name"), F.lower(strip("source_type")).alias("source_type"),
        *[strip(c).alias(c) for c in ("title", "summary", "body", "url")], "published_at", "collected_at",
        *[c for c in items.columns if c in ("news_id", "ingest_seq", "metadata")],
    ).withColumn("_text", settled(from_parts(F.col("title"), F.col("summary"), F.col("body"))))
    # read several times below, and by filters on the result: worked out once
    found = base.withColumns({"topics": settled(detect_topics(F.col("_text"), keywords)), "_scores": settled(score_topics(F.col("_text"), keywords)), "countries": settled(detect_countries(F.col("_text"), aliases))})
    found = found.withColumn("primary_topic", primary_topic(F.col("_scores"), list(keywords) if keywords else None)).drop("_scores")
    return found.withColumns({"country_groups": S.split_groups(F.col("countries")), "country_pairs": S.country_pairs(F.col("countries"))}).drop("_text")


def build_coded_events(rows: DataFrame) -> DataFrame:
    """Coded export rows (columns named as in the metadata) to event records; rows without two countries, one of them in the EU, left out."""
    codes = [S.coded_country(F.col(c)) for c in ("Actor1CountryCode_raw", "Actor2CountryCode_raw", "ActionGeo_CountryCode_raw")]
    root, code = (F.trim(F.coalesce(F.col(c), F.lit(""))) for c in ("EventRootCode", "EventCode"))
    out = rows.withColumn("countries", S.sorted_set(F.array(*codes))).where((F.size("countries") >= 2) & F.arrays_overlap("countries", F.array(*map(F.lit, EU))))
    out = out.withColumn("topics", S.coded_topics(root, code))
    name = lambda c, i: F.coalesce(F.nullif(F.col(c), F.lit("")), F.col("countries")[i])
    title = F.concat(F.lit("GDELT event "), name("Actor1Name", 0), F.lit(" - "), name("Actor2Name", 1), F.lit(" code "), code)
    return out.withColumns({
        "layer": F.lit("gdelt"), "title": title, "primary_topic": F.col("topics")[0],
        "country_groups": S.split_groups(F.col("countries")), "country_pairs": S.country_pairs(F.col("countries")),
    })


def relevant(events: DataFrame) -> DataFrame:
    """Events with a topic and a country."""
    return events.where((F.size(S.text_array(F.col("topics"))) > 0) & (F.size(S.text_array(F.col("countries"))) > 0))


def eu_countries(c: Column) -> Column:
    """Distinct EU members among the countries, sorted."""
    return F.array_sort(F.array_intersect(S.text_array(c), F.array(*map(F.lit, EU))))


def network_events(events: DataFrame, least: int = 2) -> DataFrame:
    """Events with at least ``least`` EU countries."""
    return events.where(F.size(eu_countries(F.col("countries"))) >= least)


def has_eu_and_other(countries: Column) -> Column:
    return (F.size(F.array_distinct(S.text_array(countries))) >= 2) & (F.size(eu_countries(countries)) >= 1)


def in_window(events: DataFrame, ts: str, now: str, days: int) -> DataFrame:
    """Events not older than ``days`` before ``now``; later ones stay."""
    return events.where(F.col(ts) >= F.lit(now).cast("timestamp") - F.expr(f"INTERVAL {24 * int(days)} HOURS"))


def with_period(events: DataFrame, ts: str, now: str, days: int) -> DataFrame:
    """Events of the current and the previous period of ``days``, marked in ``period``; older ones left out."""
    at = lambda n: F.lit(now).cast("timestamp") - F.expr(f"INTERVAL {24 * int(n)} HOURS")
    period = F.when(F.col(ts) >= at(days), "current").when(F.col(ts) >= at(2 * days), "previous")
    return events.withColumn("period", period).where(F.col("period").isNotNull())


# deduplication

def keep_first(rows: DataFrame, keys: Sequence[Column], order: Sequence[str], unless: Column | None = None) -> DataFrame:
    """The first row of each key by ``order``; rows for which ``unless`` holds are all kept.

    The first row's order is found by a grouped minimum, which combines before the shuffle, and joined back; no window has to
    hold all rows of a frequent key. ``order`` must identify a row; nulls in it sort first and are values like others.
    """
    named = [k.alias(f"_k{i}") for i, k in enumerate(keys)]
    first = rows.where(~unless) if unless is not None else rows
    first = first.select(*named, F.struct(*order).alias("_o")).groupBy(*[f"_k{i}" for i in range(len(keys))]).agg(F.min("_o").alias("_o"))
    chosen = first.select(*[F.col(f"_o.{c}").alias(f"_o_{c}") for c in order])
    if unless is not None:
        chosen = chosen.unionByName(rows.where(unless).select(*[F.col(c).alias(f"_o_{c}") for c in order]))
    return rows.join(chosen, reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_o_{c}")) for c in order]), "left_semi")


def dedup_by_url(rows: DataFrame, order: Sequence[str] = ("ingest_seq",)) -> DataFrame:
    return keep_first(rows, [F.col("url")], order, unless=F.coalesce(F.col("url"), F.lit("")) == "")


def dedup_by_title(rows: DataFrame, order: Sequence[str] = ("ingest_seq",)) -> DataFrame:
    """All rows with an empty title count as one title."""
    return keep_first(rows, [hash_title(F.col("title"))], order)


def dedup_events(rows: DataFrame, order: Sequence[str] = ("ingest_seq",)) -> DataFrame:
    """By URL first, then by title among what is left."""
    return dedup_by_title(dedup_by_url(rows, order), order)


def dedup_coded(rows: DataFrame, event_id: Column, order: Sequence[str] = ("ingest_seq",)) -> DataFrame:
    """By event id, else by title and URL."""
    key = F.coalesce(F.nullif(event_id, F.lit("")), F.concat_ws("|", F.coalesce("title", F.lit("")), F.coalesce("url", F.lit(""))))
    return keep_first(rows, [key], order)


def upsert(existing: DataFrame, new: DataFrame, key: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """One row per key: of ``new`` where it has the key, else of ``existing``; of several of one side the last by ``order``, then by their text.

    Columns that only one side has are null for the other's rows. The choice combines before the only shuffle.
    """
    both = existing.withColumn("_new", F.lit(False)).unionByName(new.withColumn("_new", F.lit(True)), allowMissingColumns=True)
    values = [c for c in both.columns if c not in (*key, "_new")]
    if not values:
        return both.select(*key).distinct()
    row = F.struct(*[F.col(f"`{c}`") for c in values])
    last = F.max_by(row, F.struct("_new", *[F.col(f"`{c}`").alias(f"_o{i}") for i, c in enumerate(order)], F.to_json(row).alias("_text")))
    chosen = both.groupBy(*[F.col(f"`{k}`") for k in key]).agg(last.alias("_row"))
    return chosen.select(*[F.col(f"`{c}`") if c in key else F.col(f"_row.`{c}`").alias(c) for c in both.columns if c != "_new"])


def newest_per_group(rows: DataFrame, group: Sequence[str], order: Sequence[Column], k: int) -> DataFrame:
    """The first ``k`` rows of each group by ``order``."""
    rank = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
    return rows.withColumn("_rank", rank).where(F.col("_rank") <= k).drop("_rank")
